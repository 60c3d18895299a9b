"""Benchmark decontamination: BM25 over an inverted index of test items, searched by block-max WAND.

The test items are the indexed documents, every passage of the training texts is a query. A term's impact on an item is
its BM25 weight divided by the item's score against itself, so a score is the weighted share of the item that a passage
holds, and one threshold serves all items. All items over the threshold are retrieved, and so is every item of which a
text holds `PART` of the 5-grams of a part that decides (below), whatever its score. By score:

* An item's terms are taken from the most common on as long as they alone stay `MARGIN` under the threshold. Passages must
  hold so much of its other, pivotal terms at least, so only pivotal postings are followed first.
* Items lie in blocks. A passage and a block are scored only if the block maxima of the passage's pivotal terms and the
  block's maximum over all common terms reach the threshold together.
* What is left is scored exactly from the postings.

Passages are windows of twice the longest item's words, one item's length apart, so an item that stands in a text lies
whole in one window. A retrieved item is verified against the text: its question (all but the last sentence) and its
answer (the last sentence) are compared by word 5-grams. A text leaks an item if it holds `FULL` of the question's
5-grams, or `PART` of the question's and of the answer's. A question of fewer than five words counts only together with
its answer: `PART` of an answer of five words or more, or an item over the score threshold.

The index of a set of items is broadcast. Its size is checked first; more items than `max_item_bytes` are split by hash
into sets, each searched in a pass of its own. Statistics (document frequency, mean length) are of all items.

Defined cases: null texts and items are empty; an empty item is never found; equal rows give equal findings; an item of
one sentence is question and answer at once; a part of fewer than five words is compared whole; empty tables give no
finding; other columns, whatever their names, pass unchanged through `without_leaks`.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.common import batch_rows, free_names, text_or_empty, written_small
from runsift.session import written

K1, B = 1.2, 0.75
THRESHOLD, MARGIN = 0.6, 0.25
FULL, PART = 0.8, 0.5
GRAM = 5
BLOCK_ITEMS = 16
# Texts in an Arrow batch, and texts searched at once.
BATCH_ROWS, SEARCHED_ROWS = 1000, 500
MAX_ITEM_BYTES = 32 * 1024 * 1024
WORD = re.compile(r"\w+")
FINDINGS = "doc_id long, tie long, item_id long, score double, question_overlap double, answer_overlap double, word_at long"
_FINDINGS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("tie", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64())]
    + [("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("word_at", pa.int64())]
)


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all sentences but the last, and of the last; one sentence is both."""
    sentences = [w for s in re.split(r"(?<=[.!?])\s+", text.strip()) if (w := words(s))]
    if len(sentences) < 2:
        whole = sentences[0] if sentences else []
        return whole, whole
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def grams(sequence: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(sequence))
    return {tuple(sequence[i : i + n]) for i in range(len(sequence) - n + 1)} if n else set()


def overlap(part: list[str], text: list[str]) -> float:
    """Share of the part's grams that the text holds."""
    wanted = grams(part)
    n = min(GRAM, len(part))
    found = {tuple(text[i : i + n]) for i in range(len(text) - n + 1)}
    return len(wanted & found) / len(wanted) if wanted else 0.0


@dataclass(frozen=True)
class ItemIndex:
    """Postings of one set of items, in blocks, with impacts that sum to 1 over an item."""

    ids: list[int | None]
    texts: list[str]
    window: int
    terms: dict[str, int]
    starts: np.ndarray  # postings of a term: starts[t] to starts[t + 1]
    items: np.ndarray  # item of a posting, ascending within a term
    impacts: np.ndarray
    block_starts: np.ndarray  # (term, block) maxima of a term's pivotal postings: block_starts[t] to block_starts[t + 1]
    blocks: np.ndarray
    block_max: np.ndarray
    common_max: np.ndarray  # per block: most that its other terms alone give one of its items
    threshold: float
    gram_keys: np.ndarray  # hashed 5-grams of the deciding parts, ascending, and the item of each
    gram_items: np.ndarray
    gram_counts: np.ndarray  # per item: 5-grams of its deciding part, the question or, if that is short, the answer

    @classmethod
    def built(
        cls, rows: list[tuple[int | None, str]], df: dict[str, int], n: int, mean: float, threshold: float
    ) -> ItemIndex:
        """Index of (item_id, text) rows; `df`, `n` and `mean` (document frequency, number, mean length) are of all items."""
        tokens = sorted(((words(t), i, t) for i, t in rows if words(t)), key=lambda x: (len(x[0]), x[1] or 0, x[2]))
        postings: dict[str, list[tuple[int, float, bool]]] = {}
        common = np.zeros(len(tokens))
        for item, (own, _, _) in enumerate(tokens):
            weight = {}
            for term in set(own):
                idf = math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
                tf = own.count(term)
                weight[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / mean))
            whole = sum(weight.values())
            # The most common terms first; of equally common ones the shorter, which texts hold more often.
            for term in sorted(weight, key=lambda w: (-df[w], len(w), w)):
                impact = weight[term] / whole
                pivotal = common[item] + impact >= threshold - MARGIN
                common[item] += 0 if pivotal else impact
                postings.setdefault(term, []).append((item, impact, pivotal))
        terms = {term: k for k, term in enumerate(postings)}
        deciding = [_deciding_part(text) for _, _, text in tokens]
        keys = [np.unique(_gram_keys(np.array([terms.get(w, -1) for w in part], np.int64))) for part in deciding]
        gram_counts = np.array([len(k) for k in keys], np.int64)
        gram_keys = np.concatenate([*keys, np.zeros(0, np.uint64)])
        by_key = np.argsort(gram_keys, kind="stable")
        sizes = np.array([len(p) for p in postings.values()], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        items = np.array([i for p in postings.values() for i, _, _ in p], np.int64)
        impacts = np.array([v for p in postings.values() for _, v, _ in p])
        pivotal = np.array([x for p in postings.values() for _, _, x in p], bool)
        key = (np.repeat(np.arange(len(terms)), sizes) * (len(tokens) + 1) + items // BLOCK_ITEMS)[pivotal]
        unique, first = np.unique(key, return_index=True)
        maxima = np.maximum.reduceat(impacts[pivotal], first) if len(first) else np.zeros(0)
        counts = np.bincount(unique // (len(tokens) + 1), minlength=len(terms))
        common_max = np.maximum.reduceat(common, np.arange(0, len(common), BLOCK_ITEMS)) if len(common) else common
        return cls(
            [i for _, i, _ in tokens],
            [t for _, _, t in tokens],
            max((len(own) for own, _, _ in tokens), default=1),
            terms,
            starts,
            items,
            impacts,
            np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
            unique % (len(tokens) + 1),
            maxima,
            common_max,
            threshold,
            gram_keys[by_key],
            np.repeat(np.arange(len(tokens)), gram_counts)[by_key],
            gram_counts,
        )

    def holding(self, terms: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, item): texts that hold `PART` of the 5-grams of an item's deciding part."""
        if len(terms) < GRAM or not len(self.gram_keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Five known words in a row, all of one text.
        unknown = np.concatenate([[0], np.cumsum(terms < 0)])
        at = np.flatnonzero((unknown[GRAM:] == unknown[:-GRAM]) & (text_of[GRAM - 1 :] == text_of[: 1 - GRAM]))
        key, text = _gram_keys(terms)[at], text_of[at]
        begin, end = np.searchsorted(self.gram_keys, key, "left"), np.searchsorted(self.gram_keys, key, "right")
        place, row = _ranges(begin, end)
        found = np.unique(text[row] * len(self.gram_keys) + place)
        n = len(self.ids)
        pair, held = np.unique(found // len(self.gram_keys) * n + self.gram_items[found % len(self.gram_keys)], return_counts=True)
        pair = pair[held >= PART * self.gram_counts[pair % n] - 1e-9]
        return pair // n, pair % n

    def best_window(self, item: int, terms: np.ndarray, n_windows: int) -> tuple[float, int]:
        """The item's score in the window of a text where it is highest, and the number of that window."""
        postings = np.flatnonzero(self.items == item)
        own = np.searchsorted(self.starts, postings, "right") - 1
        impact = np.zeros(len(self.terms) + 1)
        impact[own] = self.impacts[postings]
        scores = [
            float(impact[np.unique(terms[k * self.window : (k + 2) * self.window])].sum()) for k in range(n_windows)
        ]
        best = int(np.argmax(scores))
        return scores[best], best

    def retrieved(
        self, terms: np.ndarray, n_windows: int, windows_of: np.ndarray, last_of: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, score) of all items over the threshold.

        `terms` are term numbers (-1: in no item) at the positions of all texts; a position lies in windows
        `windows_of` to `last_of`.
        """
        known = np.flatnonzero(terms >= 0)
        hot = known[np.diff(self.block_starts)[terms[known]] > 0]
        window, term = _once(self._in_windows(hot, windows_of, last_of), terms, hot, len(self.terms))
        # Block maxima of the pivotal terms, and the bound of the common ones, for every (window, block) they touch.
        n_blocks = len(self.common_max)
        at, row = _ranges(self.block_starts[term], self.block_starts[term + 1])
        key, back = np.unique(window[row] * n_blocks + self.blocks[at], return_inverse=True)
        bound = np.bincount(back, self.block_max[at], len(key)) + self.common_max[key % n_blocks]
        key = key[bound >= self.threshold - 1e-9]
        if not len(key):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        # Exact scores in the blocks that are left, from all terms of their windows.
        live = np.zeros(n_windows, bool)
        live[key // n_blocks] = True
        near = known[live[windows_of[known]] | live[last_of[known]]]
        window, term = _once(self._in_windows(near, windows_of, last_of), terms, near, len(self.terms))
        kept = live[window]
        window, term = window[kept], term[kept]
        at, row = _ranges(self.starts[term], self.starts[term + 1])
        block_key = window[row] * n_blocks + self.items[at] // BLOCK_ITEMS
        inside = np.isin(block_key, key)
        pair, back = np.unique(window[row][inside] * len(self.ids) + self.items[at][inside], return_inverse=True)
        score = np.bincount(back, self.impacts[at][inside], len(pair))
        over = score >= self.threshold
        return pair[over] // len(self.ids), pair[over] % len(self.ids), score[over]

    @staticmethod
    def _in_windows(positions: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, row = _ranges(first[positions], last[positions] + 1)
        return at, row


def _deciding_part(text: str) -> list[str]:
    """The question, or the answer of a question of fewer than five words; nothing if both are that short."""
    return next((part for part in question_and_answer(text) if len(part) >= GRAM), [])


def _gram_keys(terms: np.ndarray) -> np.ndarray:
    """A hash of the five term numbers from each position on."""
    keys = np.zeros(max(len(terms) - GRAM + 1, 0), np.uint64)
    for k in range(GRAM):
        keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        keys += terms[k : k + len(keys)].astype(np.uint64)
    return keys


def is_leak(index: ItemIndex, item: int, score: float, question_overlap: float, answer_overlap: float) -> bool:
    question, answer = question_and_answer(index.texts[item])
    over = score >= index.threshold
    full = question_overlap >= FULL and (over or len(question) >= GRAM)
    part = question_overlap >= PART and answer_overlap >= PART
    return full or (part and (over or len(question) >= GRAM or len(answer) >= GRAM))


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one after the other, and the range each comes from."""
    sizes = end - begin
    row = np.repeat(np.arange(len(begin)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[row], row


def _once(
    placed: tuple[np.ndarray, np.ndarray], terms: np.ndarray, positions: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Each term once per window."""
    window, row = placed
    key = np.sort(window * n + terms[positions[row]])
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key // n, key % n


def _search(index: ItemIndex, texts: list[str]) -> Iterator[tuple[int, int, float, float, float, int]]:
    """(text, item, score, question overlap, answer overlap, first word of the window) for a batch of texts."""
    tokens = [words(t) for t in texts]
    lengths = np.array([len(t) for t in tokens], np.int64)
    lookup = index.terms.get
    flat = np.fromiter((lookup(w, -1) for t in tokens for w in t), np.int64, int(lengths.sum()))
    if not len(flat) or not len(index.ids):
        return
    # Window k of a text covers its words from k times `window` on, twice `window` of them; the last may be shorter.
    counts = np.maximum(1, -(-lengths // index.window) - 1)
    before = np.cumsum(counts) - counts
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    position = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    last = np.minimum(position // index.window, counts[text_of] - 1)
    first = np.maximum(position // index.window - 1, 0)
    window, item, score = index.retrieved(
        flat, int(counts.sum()), before[text_of] + np.minimum(first, last), before[text_of] + last
    )
    text = np.searchsorted(before, window, "right") - 1
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for t, i, s, w in zip(text.tolist(), item.tolist(), score.tolist(), (window - before[text]).tolist(), strict=True):
        if s > best.get((t, i), (0.0, 0))[0]:
            best[t, i] = (s, w * index.window)
    starts = np.cumsum(lengths) - lengths
    for t, i in zip(*(x.tolist() for x in index.holding(flat, text_of)), strict=True):
        if (t, i) not in best:
            s, w = index.best_window(i, flat[starts[t] : starts[t] + lengths[t]], int(counts[t]))
            best[t, i] = (s, w * index.window)
    for (t, i), (s, at) in best.items():
        question, answer = question_and_answer(index.texts[i])
        yield t, i, s, overlap(question, tokens[t]), overlap(answer, tokens[t]), at


def findings(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, max_item_bytes: int = MAX_ITEM_BYTES
) -> DataFrame:
    """(doc_id, tie, item_id, score, question_overlap, answer_overlap, word_at): verified leaks.

    `docs` has doc_id and text, `items` item_id and text; tie is a hash of the document's text.
    """
    batch_rows(docs.sparkSession, BATCH_ROWS)
    text = text_or_empty("text")
    own = items.select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"))
    n_bytes, n = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    shards = max(1, math.ceil(n_bytes / max_item_bytes))
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    term_lists = own.withColumn("words", _words_column("text"))
    mean = term_lists.agg(F.avg(F.size("words"))).first()[0] or 1.0
    frequencies = term_lists.select("item_id", F.explode(F.array_distinct("words")).alias("term"))
    frequencies = frequencies.groupBy("term").agg(F.count("*").alias("df"))
    found = None
    for k in range(shards):
        part = own.where(shard == k)
        chosen = part.select(F.explode(F.array_distinct(_words_column("text"))).alias("term")).distinct()
        df = {r.term: r.df for r in frequencies.join(chosen, "term", "left_semi").toLocalIterator()}
        index = ItemIndex.built([(r.item_id, r.text) for r in part.collect()], df, n, mean, threshold)
        passed = _searched(rows, index)
        found = passed if found is None else found.union(passed)
    return found


def _words_column(name: str) -> Column:
    """The words as `words` finds them, so that frequencies fit the index."""
    return F.pandas_udf(lambda s: s.map(words), "array<string>")(F.col(name))


def _searched(rows: DataFrame, index: ItemIndex) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), SEARCHED_ROWS):
                part = batch.slice(begin, SEARCHED_ROWS)
                ids, ties = part["doc_id"].to_pylist(), part["tie"].to_pylist()
                out = [
                    (ids[t], ties[t], shared.value.ids[i], s, q, a, at)
                    for t, i, s, q, a, at in _search(shared.value, part["text"].to_pylist())
                    if is_leak(shared.value, i, s, q, a)
                ]
                columns = list(zip(*out, strict=True)) or [()] * len(_FINDINGS_ARROW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _FINDINGS_ARROW, strict=True)], schema=_FINDINGS_ARROW
                )

    return rows.mapInArrow(search, FINDINGS)


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, with all columns, that leak no item."""
    doc, tie = free_names(docs, "leaks_id", "leaks_tie")
    leaks = written(findings(docs.select("doc_id", "text"), items), "leaks")
    leaks = leaks.select(F.col("doc_id").alias(doc), F.col("tie").alias(tie)).distinct()
    leaks = written_small(leaks, "leaking-documents", 32)
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(doc))
    return docs.join(leaks, same & (F.xxhash64(text_or_empty(docs["text"])) == F.col(tie)), "left_anti")
