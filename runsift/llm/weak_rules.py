"""Quality rules as weak supervision: each rule votes good, bad or abstains, and the votes are weighed together.

No rule decides alone. Every whole text is measured once and each rule of `RULES` votes on its measure. How often a rule
votes either way on good and on bad documents is not known beforehand; expectation-maximisation estimates it, with the
share of good documents, from how all documents were voted on, without any label. A document's quality is the posterior
probability of being good, given its votes.

The estimate needs only how many documents have which votes: at most 3 to the power of the number of rules (1,594,323)
rows, whatever the number of documents, counted in Spark over all of them. The weights are a few numbers.

Repeated words are counted exactly: windows are numbered by doubling (two words, four, eight), not by hashes.

Defined cases: null and empty texts have no words, every rule abstains, and the base rule rejects them; null and shared
ids and repeated rows keep their rows, equal texts get equal votes; an empty table gives no rows; without any vote the
probability is the starting share of good documents; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.common import batch_bytes, text_or_empty
from runsift.session import written

SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Words of a stretch within which distinct words are counted.
STRETCH = 100
BATCH_BYTES = 1 << 22
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
KEPT_FROM = 0.5
GOOD, ABSTAIN, BAD = 1, 0, -1

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Votes on a measure: good within [good_low, good_high], bad outside (bad_low, bad_high), else nothing.

    It abstains on texts with fewer words than `least_words`.
    """

    measure: str
    good_low: float
    good_high: float
    bad_low: float
    bad_high: float
    least_words: int = 1

    def votes(self, measures: dict[str, np.ndarray]) -> np.ndarray:
        value = measures[self.measure]
        with np.errstate(invalid="ignore"):
            good = (value >= self.good_low) & (value <= self.good_high)
            bad = (value <= self.bad_low) | (value >= self.bad_high)
        out = np.where(good, GOOD, np.where(bad, BAD, ABSTAIN))
        return np.where((measures["words"] >= self.least_words) & ~np.isnan(value), out, ABSTAIN)


_INF = float("inf")
# Limits in the range that published web-corpus filters use.
RULES = (
    Rule("word_length", 3.0, 10.0, 2.0, 12.0),
    Rule("symbols_per_word", -_INF, 0.02, -_INF, 0.1),
    Rule("repeated_words", -_INF, 0.1, -_INF, 0.3, WINDOW),
    Rule("repeated_lines", -_INF, 0.1, -_INF, 0.3, 2),
    Rule("stuttered_words", -_INF, 0.03, -_INF, 0.1, 20),
    Rule("distinct_words", 0.5, _INF, 0.35, _INF, 20),
    Rule("capitals", -_INF, 0.1, -_INF, 0.3, 5),
    Rule("sentence_ends", 0.02, 0.25, 0.005, 0.4, 50),
    Rule("lettered_words", 0.9, _INF, 0.8, _INF),
    Rule("ended_lines", 0.5, _INF, 0.12, _INF, 20),
    Rule("plain_characters", 0.85, _INF, 0.75, _INF),
    Rule("mark_runs", -_INF, 0.05, -_INF, 0.2, 5),
    Rule("bare_marks", -_INF, 0.05, -_INF, 0.2, 5),
)


def _numbered(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each pair, equal for equal pairs."""
    return np.unique(left * (np.int64(right.max()) + 1) + right, return_inverse=True)[1].astype(np.int64)


def repeated_words(ids: np.ndarray) -> int:
    """How many words stand in a window of eight words that the text holds twice or more."""
    if len(ids) <= WINDOW:
        return 0
    size, numbers = 1, ids
    while size < WINDOW:
        numbers = _numbered(numbers[:-size], numbers[size:])
        size *= 2
        # No repeated shorter window, no repeated longer one.
        if numbers.max() + 1 == len(numbers):
            return 0
    begins = np.flatnonzero(np.bincount(numbers)[numbers] > 1)
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, begins, 1)
    np.add.at(edges, begins + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def measured(text: str) -> tuple[list[int], list[float]]:
    """The counts of BASE and the measures of the rules; a measure that a text cannot have is NaN.

    Letters beyond ASCII count as letters without case.
    """
    data = text.encode("utf-8", "surrogatepass")
    words, n_bytes = data.split(), np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, spaces, symbols = len(words), int(n_bytes[_SPACES].sum()), int(n_bytes[_SYMBOLS].sum())
    if not n:
        return [0, 0, symbols, 0, 0], [float("nan")] * len(MEASURES)
    lines = [line for line in data.split(b"\n") if line.strip()]
    repeated_lines = len(lines) - len(set(lines))
    upper, lower, wide = int(n_bytes[65:91].sum()), int(n_bytes[97:123].sum()), int(n_bytes[0xC0:].sum())
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    repeats = repeated_words(ids)
    stretches = len(np.unique((np.arange(n) // STRETCH) * len(known) + ids))
    chars = len(text) - spaces
    return [n, chars, symbols, repeated_lines, repeats], [
        float(n),
        chars / n,
        symbols / n,
        repeats / n,
        repeated_lines / len(lines),
        float((ids[1:] == ids[:-1]).sum()) / n,
        stretches / n,
        upper / (upper + lower) if upper + lower else float("nan"),
        sum(w[-1] in _SENTENCE_ENDS for w in words) / n,
        sum(any(b in _LETTERS for b in w) for w in words) / n,
        sum(line.rstrip().endswith(_LINE_ENDS) for line in lines) / len(lines),
        (upper + lower + wide + spaces) / len(text),
        sum(w[-1] not in _NO_MARKS and w[-1] == w[-2] for w in words if len(w) > 1) / n,
        sum(all(b not in _NO_MARKS for b in w) for w in words) / n,
    ]


MEASURES = (
    "words", "word_length", "symbols_per_word", "repeated_words", "repeated_lines", "stuttered_words", "distinct_words",
    "capitals", "sentence_ends", "lettered_words", "ended_lines", "plain_characters", "mark_runs",
    "bare_marks",
)
_SPACES, _SYMBOLS = list(b" \t\n\x0b\x0c\r"), list(SYMBOLS.encode())
_LETTERS = frozenset([*range(65, 91), *range(97, 123), *range(128, 256)])
_NO_MARKS = _LETTERS | frozenset(range(48, 58))
_SENTENCE_ENDS = frozenset(b".!?")
_LINE_ENDS = tuple(mark.encode() for mark in ".!?…。！？\"'”’»)")


def _measure_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measured(text) for text in batch["text"].to_pylist()]
        base = np.array([r[0] for r in rows], np.int64).reshape(-1, len(BASE))
        table = np.array([r[1] for r in rows], float).reshape(-1, len(MEASURES))
        measures = {name: table[:, i] for i, name in enumerate(MEASURES)}
        votes = np.zeros(len(rows), np.int64)
        for rule in reversed(RULES):
            votes = votes * 3 + rule.votes(measures) + 1
        columns = [batch["doc_id"], *[pa.array(base[:, i]) for i in range(len(BASE))], pa.array(votes)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", *BASE, "votes"])


def voted(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of BASE, votes): votes are the digits of a number to base 3, bad 0, abstain 1, good 2."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in BASE)}, votes long"
    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    with batch_bytes(docs.sparkSession, BATCH_BYTES):
        return written(rows.mapInArrow(_measure_rows, schema), "quality-votes")


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and per rule how many of its votes on good and on bad documents are good ones."""

    prior: float
    on_good: np.ndarray
    on_bad: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        """Log odds that a vote of each rule adds: bad, nothing, good."""
        bad = np.log(1 - self.on_good) - np.log(1 - self.on_bad)
        return np.stack([bad, np.zeros(len(bad)), np.log(self.on_good) - np.log(self.on_bad)], axis=1)

    def logits(self, votes: np.ndarray) -> np.ndarray:
        """Log odds of being good for rows of votes 0, 1, 2."""
        each = self.weights[np.arange(votes.shape[1]), votes]
        return np.log(self.prior / (1 - self.prior)) + each.sum(axis=1)

    def probability(self, votes: Column) -> Column:
        """The posterior for a column of vote numbers: a sum of looked-up weights."""
        logit = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for j, row in enumerate(self.weights.tolist()):
            digit = F.floor(votes / F.lit(3**j)) % 3
            logit = logit + F.when(digit == 0, row[0]).when(digit == 1, row[1]).otherwise(row[2])
        return 1 / (1 + F.exp(-logit))


def digits(numbers: np.ndarray) -> np.ndarray:
    return (numbers[:, None] // 3 ** np.arange(len(RULES))) % 3


# What is believed before any vote is counted: the share of good documents, and of a rule's votes on good and on bad
# documents those that are good.
START_PRIOR, ON_GOOD, ON_BAD = 0.8, 0.98, 0.55
# The belief weighs as much as this share of all documents, so that its weight does not fade as a corpus grows.
BELIEF = 0.1
STEPS, ENOUGH = 500, 1e-10


def fitted(votes: np.ndarray, counts: np.ndarray) -> VoteModel:
    """Expectation-maximisation over distinct rows of votes and how many documents have them.

    Faults of different kinds seldom meet in one document, so votes alone would explain the commonest fault and call the
    other rules useless. The belief that a rule seldom votes bad on good documents keeps each rule's say.
    """
    rules, total = votes.shape[1], counts.sum()
    model = VoteModel(START_PRIOR, np.full(rules, ON_GOOD), np.full(rules, ON_BAD))
    if not total:
        return model
    said_good, said_bad = (votes == 2).astype(float), (votes == 0).astype(float)
    believed = BELIEF * total
    for _ in range(STEPS):
        good = 1 / (1 + np.exp(-model.logits(votes)))
        shares = []
        for weight, belief in ((counts * good, ON_GOOD), (counts * (1 - good), ON_BAD)):
            up, down = weight @ said_good, weight @ said_bad
            shares.append((up + believed * belief) / (up + down + believed))
        prior = float((counts @ good + believed * START_PRIOR) / (total + believed))
        old = (model.on_good, model.on_bad)
        change = max(abs(prior - model.prior), *(np.abs(a - b).max() for a, b in zip(shares, old, strict=True)))
        model = VoteModel(prior, *shares)
        if change < ENOUGH:
            break
    return model


def fitted_on(rows: DataFrame) -> VoteModel:
    """The model of all rows of `voted`; the driver gets one count per distinct combination of votes."""
    table = rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").toArrow()
    return fitted(digits(table["votes"].to_numpy()), table["n"].to_numpy().astype(float))


def base_failed() -> Column:
    """Too short, or too many words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, counts of BASE, base_failed, quality, kept) for every document."""
    rows = voted(docs)
    quality = fitted_on(rows).probability(F.col("votes"))
    rows = rows.withColumn("base_failed", base_failed()).withColumn("quality", F.round(quality, 6))
    kept = ~F.col("base_failed") & (F.col("quality") >= KEPT_FROM)
    return rows.select("doc_id", *BASE, "base_failed", "quality", kept.alias("kept"))
