"""Shared scratch folder, durable intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of driver-side and per-executor memory that a broadcast table may take.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# Spark gives a table without statistics a size beyond this.
_UNKNOWN_BYTES = 1 << 60


@functools.lru_cache(maxsize=None)
def _local_scratch(app_id: str) -> str:
    return tempfile.mkdtemp(prefix="runsift-")


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary folder only for an unset local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_scratch(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/runsift/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back: it survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Bytes a narrow table takes in memory, counted by one aggregate job."""
    width = F.lit(16)
    for name, kind in df.dtypes:
        width = width + (
            F.coalesce(F.octet_length(name), F.lit(0)) + 16 if kind == "string" else F.lit(16)
        )
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def source_bytes(df: DataFrame) -> int:
    """Bytes of the tables a DataFrame reads, from the optimizer's statistics; nothing is scanned.

    What has no statistics (rows made in the session) counts as nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN_BYTES)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return measured_bytes(df) <= limit


def broadcast_if_small(
    df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES, stored: bool = False
) -> DataFrame:
    """Broadcast a narrow table only after counting its bytes; otherwise leave the join to shuffle.

    The table is written first, so that it is computed once for the count and the join; ``stored``
    says that it is read from files already.
    """
    kept = df if stored else written(df, "measured")
    return F.broadcast(kept) if fits_broadcast(kept, limit) else kept
