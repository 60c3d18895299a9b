"""Top-k, pages and ranks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsift.schemas import PAGE_SIZE
from runsift.session import broadcast_if_small, written

# Hits that one task sorts where all hits are ranked or put in pages.
TASK_HITS = 250_000


def _order():
    return [F.desc("score"), F.asc("project"), F.asc("number")]


def _group_limit(scored: DataFrame) -> int:
    """Up to how many rows per group Spark keeps in each task before it shuffles."""
    return int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))


def top_hits(scored: DataFrame, k: int = PAGE_SIZE) -> DataFrame:
    """Add rank 1..k per query. Spark keeps only k rows per query and task before it shuffles; where
    k is over the limit for that, all hits are ranked by ranges instead of one task per query."""
    if k > _group_limit(scored):
        return rank_all(scored).where(F.col("rank") <= k)
    by_query = Window.partitionBy("qid").orderBy(*_order())
    return scored.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)


def next_page(scored: DataFrame, cursors: DataFrame, k: int = PAGE_SIZE) -> DataFrame:
    """The k hits after each query's cursor (qid, score, project, number); rank counts from the cursor.

    ``cursors`` is a stored table with one row per query, the last hit of the page before; it is
    counted, and broadcast if it fits.
    """
    last = cursors.select(
        "qid",
        F.col("score").alias("_s"),
        F.col("project").alias("_p"),
        F.col("number").alias("_n"),
    )
    after = scored.join(broadcast_if_small(last), "qid").where(
        (F.col("score") < F.col("_s"))
        | (
            (F.col("score") == F.col("_s"))
            & (
                (F.col("project") > F.col("_p"))
                | ((F.col("project") == F.col("_p")) & (F.col("number") > F.col("_n")))
            )
        )
    )
    return top_hits(after.drop("_s", "_p", "_n"), k)


def slices_of(n_hits: int) -> int:
    """Tasks for so many hits, TASK_HITS each."""
    return max(1, math.ceil(n_hits / TASK_HITS))


def rank_all(scored: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rank every hit of every query without putting one query's hits into one task.

    Hits are written and counted, range-partitioned in rank order, and sorted and numbered where they
    then stand. A rank follows from that number and the sizes of the slices before, so the numbered
    hits are not shuffled again.
    """
    keys = [F.asc("qid"), *_order()]
    # The bounds of the ranges are sampled first: without this, every document would be scored twice.
    kept = written(scored, "scored")
    spread = kept.repartitionByRange(partitions or slices_of(kept.count()), *keys)
    numbered = spread.sortWithinPartitions(*keys).select(
        "*", F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("at")
    )
    slices = written(numbered, "ranked")
    before = (
        Window.partitionBy("qid").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per query and slice, not per hit.
    sizes = (
        slices.groupBy("qid", "slice")
        .agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
        .select("qid", "slice", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("first")).alias("base"))
    )
    return (
        slices.join(broadcast_if_small(sizes), ["qid", "slice"])
        .withColumn("rank", F.col("base") + F.col("at"))
        .drop("slice", "at", "base")
    )


def with_page(ranked: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    return ranked.withColumn("page", F.ceil(F.col("rank") / page_size).cast("int"))


def page_counts(scored: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(qid, n_hits, last_page): how far a user can page, from counts alone."""
    return (
        scored.groupBy("qid")
        .agg(F.count(F.lit(1)).alias("n_hits"))
        .withColumn("last_page", F.ceil(F.col("n_hits") / page_size).cast("int"))
    )


def first_hit(scored: DataFrame) -> DataFrame:
    """The best hit of each query."""
    return top_hits(scored, 1).drop("rank")
