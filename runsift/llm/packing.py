"""Best-fit packing of token sequences by a configuration linear program over the length histogram.

A configuration says how many pieces of which lengths share a sequence. The covering program (as few sequences as
possible, every piece packed) is solved by multiplicative weights: lengths that lag behind weigh more, and pricing finds
the configuration of most weight by a knapsack dynamic program over the capacity. Its solution is rounded down to whole
numbers of sequences; what is left, and the gaps, are filled by best fit, longest first.

Only the histogram reaches the driver: at most one count per length up to the capacity, whatever the corpus. Lengths are
grouped into classes of about equal count for the program; a configuration over classes is carried out with the real
lengths. The plan speaks of ranks: "of the pieces of length l, those of rank r to s go, c to a sequence, into sequences
from b on". Ranks come from counts per input task and length and a running count inside a task, so no length, however
common, is sorted or gathered. A plan has some ten thousand rows at most and is broadcast; its size is bounded by the
capacity and the number of configurations, not by the data.

Defined cases: a null text is empty, so its document is the end id alone; repeated rows and null ids are packed each;
pieces of equal length are interchangeable and take ranks in input order; empty tables give no row; other columns are
not read.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsift.llm.common import batch_bytes, text_or_empty, written_small
from runsift.llm.tokens import BATCH_BYTES, END_ID, VOCABULARY, crc32_of, encoder, vocabulary_path
from runsift.session import written

CAPACITY = 4096
CLASSES = 128
# Multiplicative weights: how far every class is covered in total, and by how much a step may raise one class.
HORIZON, STEP = 10.0, 0.5
# Where classes hold several lengths, so much of the solution is carried out; best fit closes the gaps with the rest.
CARRIED = 0.9
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank_in_task long"
_PIECES_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
    + [("ids_crc32", pa.int64()), ("task", pa.int32()), ("rank_in_task", pa.int64())]
)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document's ids: longer documents are cut every `capacity` ids, others stay whole."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            columns: dict[str, list] = {n: [] for n in _PIECES_ARROW.names}
            texts = encoder(vocabulary_path(vocabulary)).ids(batch["text"], end_id)
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), texts, strict=True):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    row = (doc_id, piece, start, len(part), crc32_of(part), task, int(seen[len(part)]))
                    seen[len(part)] += 1
                    for name, value in zip(columns, row, strict=True):
                        columns[name].append(value)
            yield pa.RecordBatch.from_pydict(columns, _PIECES_ARROW)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(cut, PIECES)


# --- the program over the histogram -------------------------------------------------------------------------------


def size_classes(counts: np.ndarray, classes: int) -> np.ndarray:
    """Class of every length (-1 where no piece has it): runs of neighbouring lengths of about equal count."""
    lengths = np.flatnonzero(counts)
    out = np.full(len(counts), -1)
    if len(lengths) <= classes:
        out[lengths] = np.arange(len(lengths))
        return out
    middle = np.cumsum(counts[lengths]) - counts[lengths] / 2
    raw = np.minimum((middle / counts[lengths].sum() * classes).astype(int), classes - 1)
    out[lengths] = np.unique(raw, return_inverse=True)[1]
    return out


def priced(sizes: np.ndarray, most: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Knapsack: how many of each class, at most `most`, fit the capacity with the greatest total price."""
    best = np.zeros(capacity + 1)
    taken: list[tuple[int, int, np.ndarray]] = []
    for k, size in enumerate(sizes):
        left, bundle = min(int(most[k]), capacity // int(size)), 1
        while left > 0:
            bundle = min(bundle, left)
            left -= bundle
            room = bundle * int(size)
            with_it = best[: capacity + 1 - room] + bundle * prices[k]
            better = with_it > best[room:]
            best[room:][better] = with_it[better]
            taken.append((k, bundle, better))
            bundle *= 2
    out, at = np.zeros(len(sizes), np.int64), int(best.argmax())
    for k, bundle, better in reversed(taken):
        room = bundle * int(sizes[k])
        if at >= room and better[at - room]:
            out[k] += bundle
            at -= room
    return out


def fractional_cover(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> dict[tuple[int, ...], float]:
    """Configurations over classes and how many sequences of each, covering every class's demand.

    A class's price is its size times a weight that falls exponentially with how far the class is covered already; a
    fully covered class has no price. The first prices make full sequences, the weights balance the classes.
    """
    covered, amounts = np.zeros(len(sizes)), defaultdict(float)
    while len(sizes) and covered.min() < HORIZON:
        missing = np.maximum(HORIZON - covered, 0.0)
        weights = np.where(missing > 0, np.exp(covered.min() - covered), 0.0)
        config = priced(sizes, np.maximum(np.ceil(demand * missing), 1), weights * sizes, capacity)
        used = config > 0
        step = (demand[used] * np.clip(missing[used], 1e-9, STEP) / config[used]).min()
        covered += step * config / demand
        amounts[tuple(config)] += step
    return {config: amount / HORIZON for config, amount in amounts.items()}


@dataclass
class _Group:
    """`times` sequences with the same content: (length, how many) in order."""

    items: tuple[tuple[int, int], ...]
    times: int
    free: int


@dataclass
class _Packing:
    left: np.ndarray
    groups: list[_Group] = field(default_factory=list)

    def carry_out(self, config: tuple[int, ...], times: int, members: list[np.ndarray], capacity: int) -> None:
        """Make `times` sequences of a configuration, each class standing for its real lengths, longest first.

        The last piece of a sequence is the longest of any class that fits the room that is left.
        """
        open_ = [_Group((), times, capacity)]
        slots = [k for k in reversed(np.flatnonzero(config)) for _ in range(config[k])]
        for place, k in enumerate(slots, 1):
            after: list[_Group] = []
            for group in open_:
                choice = np.arange(group.free + 1) if place == len(slots) and len(slots) > 1 else members[k]
                waiting = group.times
                for length in choice[self.left[choice] > 0][::-1].tolist():
                    n = min(waiting, int(self.left[length]))
                    self.left[length] -= n
                    after.append(_Group((*group.items, (length, 1)), n, group.free - length))
                    waiting -= n
                    if not waiting:
                        break
                if waiting:
                    after.append(_Group(group.items, waiting, group.free))
            open_ = after
        self.groups += [g for g in open_ if g.items]

    def fill(self, capacity: int) -> None:
        """Best fit, longest first: each remaining piece goes where the least room remains, or into a new sequence."""
        by_free: dict[int, list[_Group]] = defaultdict(list)
        for group in self.groups:
            by_free[group.free].append(group)
        frees = sorted(by_free)

        def add(group: _Group) -> None:
            if not by_free[group.free]:
                bisect.insort(frees, group.free)
            by_free[group.free].append(group)

        for length in np.flatnonzero(self.left)[::-1].tolist():
            waiting = int(self.left[length])
            while waiting:
                at = bisect.bisect_left(frees, length)
                if at == len(frees):
                    add(_Group((), -(-waiting // (capacity // length)), capacity))
                    continue
                free = frees[at]
                group = by_free[free].pop()
                if not by_free[free]:
                    frees.pop(at)
                each = free // length
                full = min(group.times, waiting // each)
                rest = waiting - full * each if full < group.times else 0
                if full:
                    add(_Group((*group.items, (length, each)), full, free - each * length))
                if rest:
                    add(_Group((*group.items, (length, rest)), 1, free - rest * length))
                if group.times > full + bool(rest):
                    add(_Group(group.items, group.times - full - bool(rest), free))
                waiting -= full * each + rest
            self.left[length] = 0
        self.groups = [g for groups in by_free.values() for g in groups if g.items]


def packing_plan(counts: np.ndarray, capacity: int = CAPACITY, classes: int = CLASSES) -> dict[str, np.ndarray]:
    """Segments of ranks by length, sorted: length, rank, first sequence, pieces of this kind in each, offset there.

    `counts[l]` is the number of pieces of length l, 1 to capacity.
    """
    class_of = size_classes(counts, classes)
    members = [np.flatnonzero(class_of == k) for k in range(class_of.max() + 1)]
    sizes = np.array([m.max() for m in members], np.int64)
    demand = np.array([counts[m].sum() for m in members], np.int64)
    packing = _Packing(counts.astype(np.int64).copy())
    amounts = fractional_cover(sizes, demand, capacity)
    carried = 1.0 if all(len(m) == 1 for m in members) else CARRIED
    for config, amount in sorted(amounts.items(), key=lambda x: (-x[1], x[0])):
        if amount * carried >= 1:
            packing.carry_out(config, int(amount * carried), members, capacity)
    packing.fill(capacity)
    rows: list[tuple[int, int, int, int, int]] = []
    ranks, sequence = np.zeros(len(counts), np.int64), 0
    for group in packing.groups:
        offset = 0
        for length, each in group.items:
            rows.append((length, int(ranks[length]), sequence, each, offset))
            ranks[length] += each * group.times
            offset += each * length
        sequence += group.times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    names = ("length", "rank", "sequence", "each", "offset")
    return {name: table[:, i] for i, name in enumerate(names)}


def placed_at(plan: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces, given their lengths and ranks among equal lengths."""
    low = np.searchsorted(plan["length"], length, "left")
    high = np.searchsorted(plan["length"], length, "right")
    while (wide := low + 1 < high).any():
        middle = (low + high) // 2
        right = wide & (plan["rank"][np.minimum(middle, len(plan["rank"]) - 1)] <= rank)
        low, high = np.where(right, middle, low), np.where(wide & ~right, middle, high)
    within = rank - plan["rank"][low]
    each = plan["each"][low]
    return plan["sequence"][low] + within // each, plan["offset"][low] + within % each * length


# --- the corpus -----------------------------------------------------------------------------------------------------


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (written, with length, task and rank_in_task) with sequence_id and offset in place of task and rank.

    Sequences hold at most `capacity` tokens and no gap.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    bases = written_small(counts.withColumn("before", F.coalesce(before, F.lit(0))), "packing-ranks", 48)
    histogram = np.zeros(capacity + 1, np.int64)
    found = bases.groupBy("length").agg(F.sum("n").alias("n")).toArrow()
    histogram[found["length"].to_numpy()] = found["n"].to_numpy()
    shared = spark.sparkContext.broadcast(packing_plan(histogram, capacity))
    ranked = pieces.join(bases.drop("n"), ["length", "task"])
    ranked = ranked.withColumn("sequence_id", F.col("before") + F.col("rank_in_task"))
    ranked = ranked.drop("before", "rank_in_task", "task").withColumn("offset", F.lit(0).cast("long"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = placed_at(shared.value, batch["length"].to_numpy(), batch["sequence_id"].to_numpy())
            columns = {n: batch[n] for n in batch.schema.names}
            columns |= {"sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns, batch.schema)

    return ranked.mapInArrow(place, ranked.schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every document."""
    with batch_bytes(docs.sparkSession, BATCH_BYTES):
        pieces = written(token_pieces(docs, capacity, vocabulary, end_id), "token-pieces")
    out = packed(pieces, capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
