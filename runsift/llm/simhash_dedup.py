"""SimHash near-duplicates by a self-join of a binary trie over the fingerprints.

A fingerprint has 64 bits: A-Z of the text are lower-cased, its words (runs of other than ASCII white space) form 3-word
shingles, and a bit is 1 if it is set in more than half of the shingles' XXH64 hashes (seed 42). Two fingerprints link at
`radius` or fewer differing bits.

The join walks pairs of trie nodes together, from the root pair down. A pair splits into its children's pairs; taking
different branches costs one bit, and a pair over the budget is pruned. The top of the trie is walked when the work is
dealt out: every pair of subtrees that can still hold a link is one group for a task. The depth of that cut follows from
the counted subtree sizes. Inside a task the sorted fingerprints are the trie (a node is a range of them) and whole
frontiers of node pairs advance at once, in bounded blocks.

Equal fingerprints are one leaf. A task gives a spanning forest of the links it finds, at most one row per fingerprint,
so a large group of near copies never becomes a table of all its pairs, and branches whose leaves are already connected
are skipped. Components of all forests are found by `components`.

Defined cases: a null text is empty; a text without words has fingerprint zero, linked like any other; repeated rows and
null ids each keep their row; a component whose ids are all null has a null component id; other columns are not read;
empty tables give no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsift.llm.common import (
    ascii_lower,
    ascii_words,
    free_names,
    hex16,
    shingle_rows,
    text_or_empty,
    vote_sums,
    voted_bits,
    written_small,
)
from runsift.llm.components import components
from runsift.session import written

SHINGLE_WORDS = 3
RADIUS = 3
# Fingerprints in a subtree that one task holds; two subtrees meet in a task.
SUBTREE_ROWS = 1 << 19
MIN_CUT, MAX_CUT = 4, 16
# Node pairs and leaf pairs that a task has in hand at once.
BLOCK = 1 << 17
LEAF_PAIRS = 64


def simhash64(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, tie, fp): one row per row of `docs`; tie is a hash of the text."""
    text = text_or_empty("text")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("__row"), F.xxhash64(text).alias("tie"), "text")
    rows = shingle_rows(rows, ascii_words(ascii_lower(text)), shingle_words).drop("text")
    words = [F.col(f"__w{k + 1}") for k in range(shingle_words)]
    hashed = F.when(F.col("__p").isNotNull(), F.xxhash64(F.concat_ws(" ", *words)))
    votes = rows.select("doc_id", "tie", "__row", hashed.alias("__h")).groupBy("doc_id", "tie", "__row")
    votes = votes.agg(F.count("__h").alias("__total"), *vote_sums(F.col("__h"), "__v"))
    return votes.select("doc_id", "tie", voted_bits("__v", F.col("__total")).alias("fp"))


class _Forest:
    """Connected leaves; `edges` are the links that joined two trees."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.edges: list[np.ndarray] = []

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            high, low = np.maximum(ra, rb), np.minimum(ra, rb)
            # One link per tree that gives up its root; the others are tried again against the new roots.
            high, first = np.unique(high, return_index=True)
            self.edges.append(np.stack([a[first], b[first]], axis=1))
            self.root[high] = low[first]
            while True:
                above = self.root[self.root]
                if np.array_equal(above, self.root):
                    break
                self.root = above

    def one_tree(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether all leaves of each range belong to one tree."""
        changes = np.concatenate([[0, 0], np.cumsum(self.root[1:] != self.root[:-1])])
        return changes[end] == changes[begin + 1]


def _expanded(
    begin_a: np.ndarray, size_a: np.ndarray, begin_b: np.ndarray, size_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All leaf pairs of the given node pairs."""
    sizes = size_a * size_b
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    width = np.repeat(size_b, sizes)
    return np.repeat(begin_a, sizes) + within // width, np.repeat(begin_b, sizes) + within % width


def trie_links(prints: np.ndarray, split: int, depth: int, radius: int) -> np.ndarray:
    """Spanning forest, as pairs of positions, of the links between prints[:split] and prints[split:].

    Both parts are sorted unsigned fingerprints of one subtree each, cut at `depth`. With nothing in the second part the
    first is joined with itself.
    """
    n = len(prints)
    forest = _Forest(n)
    own = split == n
    second = (0, n) if own else (split, n)
    spent = 0 if own else int(np.bitwise_count((prints[0] ^ prints[split]) >> np.uint64(64 - depth))) if depth else 0
    start = [np.array([x]) for x in (0, split, *second, spent)]
    stack: list[tuple[int, list[np.ndarray]]] = [(depth, start)] if split and second[1] > second[0] else []
    while stack:
        at, (a0, a1, b0, b1, bits) = stack.pop()
        if len(a0) > BLOCK:
            stack.append((at, [x[BLOCK:] for x in (a0, a1, b0, b1, bits)]))
            a0, a1, b0, b1, bits = (x[:BLOCK] for x in (a0, a1, b0, b1, bits))
        open_ = ~(forest.one_tree(a0, a1) & forest.one_tree(b0, b1) & (forest.root[a0] == forest.root[b0]))
        a0, a1, b0, b1, bits = (x[open_] for x in (a0, a1, b0, b1, bits))
        small = ((a1 - a0) * (b1 - b0) <= LEAF_PAIRS) | (at == 64)
        if small.any():
            chosen = np.flatnonzero(small)
            room = np.cumsum((a1 - a0)[chosen] * (b1 - b0)[chosen]) // (BLOCK * 4)
            for part in np.split(chosen, np.flatnonzero(np.diff(room)) + 1):
                i, j = _expanded(a0[part], (a1 - a0)[part], b0[part], (b1 - b0)[part])
                near = np.bitwise_count(prints[i] ^ prints[j]) <= radius
                near &= i < j
                forest.link(i[near], j[near])
        rest = ~small
        if not rest.any():
            continue
        a0, a1, b0, b1, bits = (x[rest] for x in (a0, a1, b0, b1, bits))
        bit = np.uint64(63 - at)
        halves = np.concatenate([[0], np.cumsum((prints >> bit) & np.uint64(1) == 0)]).astype(np.int64)
        am, bm = a0 + halves[a1] - halves[a0], b0 + halves[b1] - halves[b0]
        apart, same = [], []
        for (x0, x1, y0, y1), cost, out in (
            ((a0, am, bm, b1), 1, apart),
            ((am, a1, b0, bm), 1, apart),
            ((a0, am, b0, bm), 0, same),
            ((am, a1, bm, b1), 0, same),
        ):
            keep = (x1 > x0) & (y1 > y0) & (bits + cost <= radius)
            # Within one subtree a pair of nodes and its mirror image are the same.
            keep &= ~((x0 > y0) & own)
            out.append([x[keep] for x in (x0, x1, y0, y1, bits + cost)])
        for group in (apart, same):
            stack.append((at + 1, [np.concatenate(x) for x in zip(*group, strict=True)]))
    return np.concatenate(forest.edges) if forest.edges else np.zeros((0, 2), np.int64)


def _cut_depth(prints: DataFrame, subtree_rows: int) -> int:
    """The least depth at which every subtree fits a task, from one count per prefix."""
    prefix = F.shiftrightunsigned("fp", 64 - MAX_CUT).cast("int")
    counts = np.zeros(1 << MAX_CUT, np.int64)
    found = prints.groupBy(prefix.alias("prefix")).count().toArrow()
    counts[found["prefix"].to_numpy()] = found["count"].to_numpy()
    for depth in range(MIN_CUT, MAX_CUT + 1):
        if counts.reshape(1 << depth, -1).sum(axis=1).max() <= subtree_rows:
            return depth
    return MAX_CUT


def linked(prints: DataFrame, radius: int = RADIUS, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """(u, v): links that connect what the links of all distinct fingerprints `fp` connect."""
    depth = _cut_depth(prints, subtree_rows)
    # Walking the top of the trie: a subtree meets those whose prefix differs in no more bits than the budget.
    masks = [m for m in range(1 << depth) if m.bit_count() <= radius]
    prefix = F.shiftrightunsigned("fp", 64 - depth).cast("int")
    rows = prints.select("fp", prefix.alias("mine"), F.explode(F.lit(masks).cast("array<int>")).alias("mask"))
    other = F.col("mine").bitwiseXOR(F.col("mask"))
    rows = rows.select(F.least("mine", other).alias("a"), F.greatest("mine", other).alias("b"), "mine", "fp")

    def links_of(key: tuple[int, int], group: pd.DataFrame) -> pd.DataFrame:
        fp = group["fp"].to_numpy().view(np.uint64)
        first = (group["mine"] == key[0]).to_numpy()
        parts = [np.sort(fp[first])] if key[0] == key[1] else [np.sort(fp[first]), np.sort(fp[~first])]
        ordered = np.concatenate(parts)
        found = trie_links(ordered, len(parts[0]), depth, radius) if all(map(len, parts)) else np.zeros((0, 2), int)
        pairs = ordered[found].view(np.int64)
        return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})

    return rows.groupBy("a", "b").applyInPandas(links_of, "u long, v long")


def classified(docs: DataFrame, radius: int = RADIUS, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """(doc_id, tie, fp, root, component_id) for every document; root is the component's least fingerprint."""
    prints = written(simhash64(docs), "simhash")
    leaves = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-leaves")
    roots = written(components(linked(leaves, radius, subtree_rows)), "simhash-components")
    named = leaves.join(roots, leaves["fp"] == roots["node"], "left")
    named = written(named.select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written_small(named.join(least, "root").select("fp", "root", "component_id"), "simhash-classes")
    return prints.join(classes, "fp")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document; component_id is the least id of its component."""
    return classified(docs, radius).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each component, with all columns of `docs`: the least id, null ids last, then by text hash.

    Of rows repeated with the same id and text any one stays.
    """
    doc, tie, times_name = free_names(docs, "stays_id", "stays_tie", "stays_times")
    rows = written(classified(docs.select("doc_id", "text"), radius), "simhash-classified")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tie")
    stays = rows.groupBy("root").agg(F.min(order).alias("s"))
    times = rows.groupBy("root", "doc_id", "tie").agg(F.count("*").alias("times"))
    stays = stays.join(
        times,
        (stays["root"] == times["root"])
        & stays["s.doc_id"].eqNullSafe(times["doc_id"])
        & (stays["s.tie"] == times["tie"]),
    ).select(F.col("s.doc_id").alias(doc), F.col("s.tie").alias(tie), F.col("times").alias(times_name))
    stays = written_small(stays, "simhash-stays")
    own = docs["doc_id"].eqNullSafe(F.col(doc)) & (F.xxhash64(text_or_empty(docs["text"])) == F.col(tie))
    single = docs.join(stays.where(F.col(times_name) == 1), own, "left_semi")
    repeated = docs.join(stays.where(F.col(times_name) > 1), own).dropDuplicates([doc, tie])
    return single.union(repeated.select(*[docs[c] for c in docs.columns]))
