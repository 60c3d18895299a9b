"""The stored document table and result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runsift.schemas import KEY


def doc_part(parts: int) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(parts)).cast("int")


def write_documents(docs: DataFrame, path: str, parts: int, mode: str = "errorifexists") -> None:
    """Store documents by a hash of their key: one busy project fills all parts alike, and fetching
    the documents of some hits reads only the parts that hold them."""
    placed = docs.withColumn("dp", doc_part(parts))
    placed.repartition("dp").write.mode(mode).partitionBy("dp").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot of the stored documents; files written later are not seen by it."""
    return spark.read.parquet(path)


def pick(
    docs: DataFrame, keys: DataFrame, how: str, small: bool = False, parts: int | None = None
) -> DataFrame:
    """Join documents to keyed rows. ``small`` says that the rows are bounded and may be broadcast;
    with ``parts``, the documents were stored by write_documents and only parts in use are read."""
    if parts is None:
        return docs.join(F.broadcast(keys) if small else keys, KEY, how)
    placed = keys.withColumn("dp", doc_part(parts)).where("number IS NOT NULL AND dp >= 0")
    return docs.join(F.broadcast(placed) if small else placed, [*KEY, "dp"], how).drop("dp")


def write_hits(hits: DataFrame, path: str, kind: str = "parquet") -> None:
    """Result rows for a front end: name, link and fragments."""
    hits.write.format(kind).save(path)
