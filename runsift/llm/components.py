"""Connected components of a table of links, by alternating stars.

Each round sends every node's neighbours to its smallest neighbour: first all larger neighbours, then all smaller ones.
A round is an aggregation of minima and a join, so a node with very many links is split by the join, never gathered.
Rounds are written to the shared folder; they end when no link changes, after a number of rounds that grows with the
logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsift.session import written


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Links (u, v), u > v, moved to the least neighbour of u."""
    ways = links.union(links.select("v", "u")) if both_ways else links
    least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = ways.join(least, "u")
    if both_ways:
        return moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component. `links` has (u, v)."""
    now = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = written(now, "links")
    marks = None
    while True:
        now = written(_star(written(_star(now, True), "large-star"), False), "small-star")
        found = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if found == marks:
            break
        marks = found
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
