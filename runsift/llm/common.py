"""Helpers of the operators: words, lines, SimHash votes, measured broadcasts of written tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runsift.session import BROADCAST_LIMIT_BYTES, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# One row of two counters of 32 bits: bit k in the lower half, bit k + 32 in the upper half.
_TWO_BITS = 0x0000000100000001
_LOW_HALF = 0xFFFFFFFF


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def ascii_words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space, in order."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to clash with no column of `df`."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def batch_rows(spark: SparkSession, rows: int) -> None:
    """Rows per Arrow batch from now on in this session: rows are whole texts, so a batch must not hold many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batch_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of about so many bytes for the actions inside; the session's own setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written_small(df: DataFrame, label: str, row_bytes: int | Column = 64) -> DataFrame:
    """Write a narrow table once; broadcast what was written if its rows fit, else leave the join to shuffle.

    `row_bytes` is the size of any row, or, where rows hold arrays or texts, a column of it that is added up.
    """
    kept = written(df, label)
    size = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    return F.broadcast(kept) if (kept.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_LIMIT_BYTES else kept


def shingle_rows(df: DataFrame, words: Column, n: int, word: str = "__w", position: str = "__p") -> DataFrame:
    """One row per n-word shingle with its words in {word}1..n; fewer words than n: one row of them all; none: nulls.

    Columns of `df` stay beside it. A row's position is null only where there is no word at all.
    """
    df = df.withColumn("__words", words)
    size = F.size("__words")
    slices = [F.slice("__words", k + 1, F.greatest(size - k, F.lit(0))) for k in range(n)]
    parts = F.arrays_zip(*[s.alias(f"{word}{k + 1}") for k, s in enumerate(slices)])
    df = df.withColumn("__zipped", parts).drop("__words")
    fields = df.schema["__zipped"].dataType.elementType.names
    keep = [c for c in df.columns if c != "__zipped"]
    rows = df.select(*keep, F.posexplode_outer("__zipped").alias(position, "__z"))
    named = [F.col("__z")[f].alias(f"{word}{k + 1}") for k, f in enumerate(fields)]
    rows = rows.select(*keep, position, *named)
    full = F.col(f"{word}{n}").isNotNull()
    return rows.where(full | (F.coalesce(F.col(position), F.lit(0)) == 0))


def vote_sums(hashed: Column, name: str, weight: Column | None = None) -> list[Column]:
    """32 sums that count, in 32 bits each, how much weight sets each of a hash's 64 bits."""
    out = []
    for k in range(32):
        bits = F.shiftrightunsigned(hashed, k).bitwiseAND(F.lit(_TWO_BITS))
        out.append(F.sum(bits if weight is None else bits * weight).alias(f"{name}{k}"))
    return out


def voted_bits(name: str, total: Column) -> Column:
    """64 bits as a long; a bit is set if more than half of the total weight sets it. No weight at all: zero."""
    pieces = []
    for k in range(32):
        both = F.coalesce(F.col(f"{name}{k}"), F.lit(0).cast("long"))
        halves = ((k, both.bitwiseAND(F.lit(_LOW_HALF))), (k + 32, F.shiftrightunsigned(both, 32)))
        for bit, count in halves:
            value = (1 << bit) - ((1 << 64) if bit == 63 else 0)
            pieces.append(F.when(count * 2 > total, F.lit(value).cast("long")).otherwise(F.lit(0).cast("long")))
    return reduce(Column.bitwiseOR, pieces)


def hex16(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
