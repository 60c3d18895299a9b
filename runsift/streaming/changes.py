"""The change feed: run events to the current document table, in batch and as a stream.

Operations: ``completed`` and ``changed`` store a run's document, ``run_deleted`` removes it,
``job_deleted`` removes every document of the project stored before it. Events are ordered by
``seq``; a late event with a lower ``seq`` than the state changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from runsift.fields import FieldRegistry
from runsift.operators.documents import build_documents
from runsift.operators.maintain import runs_of
from runsift.schemas import KEY, RUN_EVENTS
from runsift.session import broadcast_if_small, written

PUT_OPS = ("completed", "changed")


def event_schema(registry: FieldRegistry | None = None) -> T.StructType:
    """Columns of run events: the built-in fields and the registered extensions' texts."""
    extensions = registry.extensions if registry else []
    return T.StructType([*RUN_EVENTS.fields, *[T.StructField(f.key, T.StringType()) for f in extensions]])


def last_changes(events: DataFrame) -> DataFrame:
    """(project, number, seq, op): the last change of each run.

    A partial aggregate: one busy run costs one row per task, not one task.
    """
    return (
        events.where("op != 'job_deleted'")
        .groupBy(*KEY)
        .agg(F.max(F.struct("seq", "op")).alias("last"))
        .select(*KEY, "last.seq", "last.op")
    )


def job_deletions(events: DataFrame) -> DataFrame:
    """(project, deleted_seq): the last deletion of each job."""
    return (
        events.where("op = 'job_deleted'").groupBy("project").agg(F.max("seq").alias("deleted_seq"))
    )


def compacted(events: DataFrame) -> DataFrame:
    """The same feed with only the last event of each run and the last deletion of each job.

    Which event wins is decided on narrow columns; only winners' payloads are fetched. Deletions
    stay in, so an older event that arrives late finds them.
    """
    runs = events.where("op != 'job_deleted'")
    winners = last_changes(events).select(*KEY, "seq")
    kept = runs.join(winners, [*KEY, "seq"], "left_semi").dropDuplicates([*KEY, "seq"])
    deletions = job_deletions(events).select(
        "project", F.col("deleted_seq").alias("seq"), F.lit("job_deleted").alias("op")
    )
    return kept.unionByName(deletions, allowMissingColumns=True)


def live(feed: DataFrame, deletions: DataFrame | None = None) -> DataFrame:
    """The documents of a compacted feed: stored, and not before a deletion of their job."""
    stored = feed.where(F.col("op").isin(*PUT_OPS)).drop("op")
    gone = job_deletions(feed) if deletions is None else deletions
    gone = broadcast_if_small(gone).alias("gone")
    return stored.alias("s").join(
        gone,
        (F.col("s.project") == F.col("gone.project"))
        & (F.col("gone.deleted_seq") > F.col("s.seq")),
        "left_anti",
    )


def latest_state(events: DataFrame) -> DataFrame:
    """The document table after all events: columns of the payload, the key and seq."""
    return live(compacted(events), job_deletions(events))


def merge(base: DataFrame, events: DataFrame) -> DataFrame:
    """Bring a compacted feed up to date with further events.

    Base rows that no event overtakes are passed through without being shuffled, as long as the
    overtaken keys fit a measured broadcast.
    """
    fresh = compacted(events)
    newer = last_changes(events).select(*KEY, F.col("seq").alias("new_seq"))
    both = written(base.where("op != 'job_deleted'").select(*KEY, "seq").join(newer, KEY), "overtaken")
    overtaken = both.where("new_seq > seq").select(*KEY)
    late = both.where("new_seq <= seq").select(*KEY)
    kept = base.join(broadcast_if_small(overtaken), KEY, "left_anti")
    added = fresh.join(broadcast_if_small(late), KEY, "left_anti")
    return kept.unionByName(added, allowMissingColumns=True)


# -- maintenance as events: nothing that is stored is rewritten ---------------------------------


def put_events(docs: DataFrame, seq: int) -> DataFrame:
    """Store or replace documents."""
    return docs.withColumn("seq", F.lit(seq).cast("bigint")).withColumn("op", F.lit("changed"))


def remove_events(keys: DataFrame, seq: int) -> DataFrame:
    return keys.select(
        *KEY, F.lit(seq).cast("bigint").alias("seq"), F.lit("run_deleted").alias("op")
    )


def drop_events(projects: DataFrame, seq: int) -> DataFrame:
    """Delete whole jobs."""
    return projects.select(
        "project", F.lit(seq).cast("bigint").alias("seq"), F.lit("job_deleted").alias("op")
    ).distinct()


def rebuild_events(
    runs: DataFrame, jobs: DataFrame, seq: int, registry: FieldRegistry | None = None
) -> DataFrame:
    """Overwrite-rebuild of jobs: each is dropped at ``seq`` and its runs are stored after that."""
    projects = jobs.select(F.col("full_name").alias("project"))
    docs = build_documents(runs_of(runs, jobs), registry)
    return drop_events(projects, seq).unionByName(
        put_events(docs, seq + 1), allowMissingColumns=True
    )


def changed_documents(
    before: DataFrame, after: DataFrame, events: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(old, new): the documents that events touched, as they were and as they are; what an index
    update takes. ``before`` and ``after`` are the live documents around the events."""
    dropped = before.select(*KEY).join(
        broadcast_if_small(job_deletions(events).select("project")), "project", "left_semi"
    )
    touched = events.where("op != 'job_deleted'").select(*KEY).unionByName(dropped).distinct()
    touched = broadcast_if_small(touched)
    fields = [c for c in before.columns if c != "seq"]
    return (
        before.join(touched, KEY, "left_semi").select(fields),
        after.join(touched, KEY, "left_semi").select(fields),
    )


@dataclass(frozen=True)
class ChangeLog:
    """Stored change feed: the batches since the last compaction, as plain Parquet folders.

    A batch is written under its stream and its own number, so a batch replayed after a failure
    replaces itself and nothing else. A stream is known by the id that its checkpoint keeps; a new
    checkpoint is a new stream. ``registry`` names the extension texts that events carry.
    """

    spark: SparkSession
    root: str
    registry: FieldRegistry | None = None

    def start(
        self,
        source: DataFrame,
        checkpoint: str,
        configure: Callable[[object], object] = lambda writer: writer,
    ) -> StreamingQuery:
        """Run the feed; each micro-batch is committed on its own."""

        def store(batch: DataFrame, batch_id: int) -> None:
            context = batch.sparkSession.sparkContext
            self.append(batch, batch_id, context.getLocalProperty("sql.streaming.queryId"))

        writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
        return configure(writer).start()

    def append(self, batch: DataFrame, batch_id: int, stream: str = "manual") -> None:
        """Store one batch; the same stream and number again replaces it."""
        batch.write.mode("overwrite").parquet(f"{self.root}/changes/stream={stream}/batch={batch_id}")

    def events(self) -> DataFrame:
        stored = self.spark.read.schema(event_schema(self.registry)).parquet(f"{self.root}/changes")
        return stored.drop("stream", "batch")

    def feed(self, base: DataFrame | None = None) -> DataFrame:
        return compacted(self.events()) if base is None else merge(base, self.events())

    def current(self, base: DataFrame | None = None) -> DataFrame:
        """The standing view: documents after every stored event."""
        events = self.events() if base is None else self.events().unionByName(
            base.where("op = 'job_deleted'"), allowMissingColumns=True
        )
        return live(self.feed(base), job_deletions(events))

    def compact(self, target: str, base: DataFrame | None = None) -> DataFrame:
        """Write the compacted feed to a new folder, as the base of a new log, and read it back."""
        feed = self.feed(base)
        feed.write.parquet(target)
        return self.spark.read.schema(feed.schema).parquet(target)


def event_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None, registry: FieldRegistry | None = None
) -> DataFrame:
    """Run events arriving as Parquet files, with the texts of the registered extensions."""
    reader = spark.readStream.schema(event_schema(registry))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
