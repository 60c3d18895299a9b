"""Document-table maintenance: each operation maps the table to its next state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.fields import FieldRegistry
from runsift.functions.text import job_label, words
from runsift.operators.documents import build_documents
from runsift.schemas import KEY
from runsift.session import broadcast_if_small


def requested_names(text: Column) -> Column:
    """The job names typed into a rebuild request."""
    return words(text)


def unknown_names(names: DataFrame, jobs: DataFrame) -> DataFrame:
    """Requested (name) rows that no job has; a request is valid when there are none."""
    return names.distinct().join(jobs.select("name").distinct(), "name", "left_anti")


def jobs_named(jobs: DataFrame, names: DataFrame) -> DataFrame:
    """Every job with a requested short name, in whatever folder."""
    return jobs.join(names.select("name").distinct(), "name", "left_semi")


def empty_jobs(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    return jobs.join(
        runs.select(F.col("project").alias("full_name")).distinct(), "full_name", "left_anti"
    )


def runs_of(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    wanted = jobs.select(F.col("full_name").alias("project")).distinct()
    return runs.join(broadcast_if_small(wanted), "project", "left_semi")


def remove_runs(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Documents without the given keys. A counted small key list leaves the documents unshuffled."""
    return docs.join(broadcast_if_small(keys.select(*KEY).distinct()), KEY, "left_anti")


def delete_jobs(docs: DataFrame, projects: DataFrame) -> DataFrame:
    """Exact project names: deleting ``app`` leaves ``app test`` alone."""
    gone = projects.select("project").distinct()
    return docs.join(broadcast_if_small(gone), "project", "left_anti")


def upsert(docs: DataFrame, new_docs: DataFrame) -> DataFrame:
    """New documents replace those with the same key."""
    return remove_runs(docs, new_docs).unionByName(new_docs, allowMissingColumns=True)


def append_documents(docs: DataFrame, new_docs: DataFrame) -> DataFrame:
    return docs.unionByName(new_docs, allowMissingColumns=True)


def run_lookup(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return docs.join(broadcast_if_small(keys.select(*KEY).distinct()), KEY, "left_semi")


def exists(docs: DataFrame, project: str, number: int) -> bool:
    """Whether a run has a document; the scan stops at the first one."""
    found = docs.where((F.col("project") == project) & (F.col("number") == number))
    return not found.select(*KEY).limit(1).isEmpty()


def rebuild_overwrite(
    docs: DataFrame, runs: DataFrame, jobs: DataFrame, registry: FieldRegistry | None = None
) -> DataFrame:
    """Replace all documents of the given jobs by their runs; a job without runs loses its documents."""
    kept = delete_jobs(docs, jobs.select(F.col("full_name").alias("project")))
    return append_documents(kept, build_documents(runs_of(runs, jobs), registry))


def rebuild_preserve(
    docs: DataFrame, runs: DataFrame, jobs: DataFrame, registry: FieldRegistry | None = None
) -> DataFrame:
    """Add only runs that have no document yet; a job without runs loses its documents."""
    gone = empty_jobs(jobs, runs).select(F.col("full_name").alias("project"))
    kept = delete_jobs(docs, gone)
    # What is missing is decided on keys alone; consoles are read only for that.
    missing = runs_of(runs.select(*KEY), jobs).join(docs.select(*KEY), KEY, "left_anti")
    return append_documents(kept, build_documents(run_lookup(runs, missing), registry))


def clean_all(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The emptied table and a report row with the number of documents there were."""
    report = docs.agg(F.count(F.lit(1)).alias("current")).select(
        F.lit("clean all").alias("name"), F.lit("COMPLETE").alias("state"), "current"
    )
    return docs.where(F.lit(False)), report


def rebuild_report(
    jobs: DataFrame, runs: DataFrame, errors: DataFrame, root: str = "root"
) -> DataFrame:
    """(full_name, name, state, current, max, reason): one row per job.

    ``errors`` (project, number, reason) lists runs that could not be stored; the others of the job
    went on, and the job shows its last reason.
    """
    totals = runs.groupBy("project").agg(F.count(F.lit(1)).alias("max"))
    bad = errors.groupBy("project").agg(
        F.count(F.lit(1)).alias("n_bad"), F.max_by("reason", "number").alias("reason")
    )
    joined = (
        jobs.withColumn("project", F.col("full_name"))
        .join(totals, "project", "left")
        .join(bad, "project", "left")
    )
    failed = F.col("n_bad").isNotNull()
    n_runs = F.coalesce("max", F.lit(0))
    return joined.select(
        "full_name",
        job_label(F.col("parent_name"), F.col("name"), root).alias("name"),
        F.when(failed, "COMPLETE_WITH_ERROR").otherwise("COMPLETE").alias("state"),
        n_runs.alias("current"),
        n_runs.alias("max"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )


def elapsed_seconds(elapsed_ms: Column) -> Column:
    """Whole seconds of a duration in milliseconds."""
    return F.floor(elapsed_ms / 1000).cast("bigint")


def rebuild_status(report: DataFrame, elapsed_ms: int | None = None) -> DataFrame:
    """One row: code, message, jobs begun and runs processed; any error makes the whole code 2.

    With the duration of the rebuild, as whoever ran it measured it, there is also ``elapsed_s``.
    """
    timed = [] if elapsed_ms is None else [elapsed_seconds(F.lit(elapsed_ms)).alias("elapsed_s")]
    failed = F.col("state") == "COMPLETE_WITH_ERROR"
    rolled = report.agg(
        F.count(F.lit(1)).alias("n_jobs"),
        F.coalesce(F.sum("max"), F.lit(0)).alias("processed_items"),
        F.max(failed.cast("int")).alias("worst"),
        F.max_by(F.when(failed, F.col("reason")), F.when(failed, F.col("full_name"))).alias("last_reason"),
    )
    return rolled.select(
        F.when(F.col("n_jobs") == 0, 0).when(F.col("worst") == 1, 2).otherwise(0).alias("code"),
        F.when(F.col("n_jobs") == 0, "Never started")
        .when(F.col("worst") == 1, F.col("last_reason"))
        .otherwise("Completed without errors")
        .alias("message"),
        F.lit(False).alias("running"),
        (F.col("n_jobs") == 0).alias("never_started"),
        "n_jobs",
        "processed_items",
        *timed,
    )


def status_json(report: DataFrame) -> DataFrame:
    """(json): rows as JSON objects, null fields kept."""
    return report.select(
        F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"}).alias("json")
    )


def split_valid(runs: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Runs that pass every check, and (project, number, reason) for the others.

    ``checks`` maps a reason to a Boolean column; a null counts as failed.
    """
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(r)) for r, ok in checks.items()])
    good = reduce(lambda a, b: a & b, [F.coalesce(ok, F.lit(False)) for ok in checks.values()])
    errors = runs.where(~good).select(*KEY, reason.alias("reason"))
    return runs.where(good), errors
