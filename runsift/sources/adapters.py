"""The engine's input tables derived from the given test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runsift.schemas import TOKEN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is one run: its source is the job, its text the console log."""
    number = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("project"),
        F.col("doc_id").alias("number"),
        F.concat(F.lit("#"), number).alias("display_name"),
        F.array(F.struct(F.lit("lang").alias("name"), F.col("lang").alias("value"))).alias("parameters"),
        F.col("text").alias("console"),
        F.concat(F.lit("job/"), "source", F.lit("/"), number, F.lit("/")).alias("url"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs per source: one at the root with its runs, one in folder ``idle`` without any."""
    sources = table(spark, sf_dir, "documents").select("source").distinct()
    return sources.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("source").alias("full_name"),
                    F.col("source").alias("name"),
                    F.lit("root").alias("parent_name"),
                ),
                F.struct(
                    F.concat(F.lit("idle/"), "source").alias("full_name"),
                    F.concat(F.lit("idle-"), "source").alias("name"),
                    F.lit("idle").alias("parent_name"),
                ),
            )
        ).alias("job")
    ).select("job.*")


# Query shapes built from the words of a benchmark item: w3, w4, w5 are its third to fifth token.
SHAPES = (
    "{w3} {w4} {w5}",
    "{w3} OR {w4} OR {w5}",
    "{w3} NOT {w4}",
    "{w3} AND {w4} OR {w5}",
    "c:{w3} j:src1 {w5}",
    'c:"{w3} {w4}" {w5}',
    "-c:{w3} {w4}",
    "src1 {w3} OR {w4}",
    "src2 NOT c:{w3} p:en",
    "AND {w3}",
    "{w3} NOT",
    "c:http://{w3}:80",
    "zz:{w3} {w4}",
    "c:{w3}/{w4} && {w5}",
    "NOT {w3}",
    "p:fr {w3}* OR {w4}",
    "d:1 OR n:12 OR {w5}",
    "src1 AND {w3}",
)


def queries(spark: SparkSession, sf_dir: str, shapes: tuple[str, ...] = SHAPES) -> DataFrame:
    """(qid, q): every shape for every benchmark item.

    {w3}, {w4} and {w5} are single tokens of the item, {all} is its whole text on one line and {any}
    all its tokens with OR between them.
    """
    found = table(spark, sf_dir, "benchmark").select(
        "item_id", "text", F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)).alias("t")
    )

    def fill(shape: str):
        text = F.lit(shape)
        for name, at in (("{w3}", 2), ("{w4}", 3), ("{w5}", 4)):
            text = F.replace(text, F.lit(name), F.coalesce(F.get("t", F.lit(at)), F.lit("none")))
        whole = {"{all}": F.translate("text", "\n\"", " "), "{any}": F.array_join("t", " OR ")}
        for name, value in whole.items():
            text = F.replace(text, F.lit(name), value) if name in shape else text
        return text

    shaped = F.array(*[fill(s) for s in shapes])
    return found.select("item_id", F.posexplode(shaped).alias("i", "q")).select(
        (F.col("item_id") * 100 + F.col("i")).alias("qid"), "q"
    )


def failed_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as failed tests of the run with that id."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    turns = table(spark, sf_dir, "conversations")
    return documents.join(turns, documents.doc_id == turns.conv_id).select(
        F.col("source").alias("project"),
        F.col("doc_id").alias("number"),
        F.col("turn").alias("seq"),
        F.col("role").alias("title"),
        F.col("text").alias("error_details"),
    )


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as artifacts of the run with that id."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    pages = table(spark, sf_dir, "pages")
    return documents.join(pages, documents.doc_id == pages.page_id).select(
        F.col("source").alias("project"),
        F.col("doc_id").alias("number"),
        F.col("url").alias("path"),
        F.col("html").alias("content"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a change feed: users are jobs, props.k is the run number."""
    op = (
        F.when(F.col("event_type") == "error", "run_deleted")
        .when(F.col("event_type") == "purchase", "job_deleted")
        .when(F.col("event_type") == "signup", "changed")
        .otherwise("completed")
    )
    number = F.get_json_object("props", "$.k").cast("bigint")
    project = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        op.alias("op"),
        project.alias("project"),
        number.alias("number"),
        project.alias("j"),
        number.cast("string").alias("n"),
        F.concat(F.lit("#"), number.cast("string")).alias("d"),
        F.concat(F.col("event_type"), F.lit(" ")).alias("p"),
        F.concat(F.lit("value "), F.col("value").cast("string")).alias("c"),
    )


def visible_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(project): sources with an even number may be seen."""
    return (
        table(spark, sf_dir, "documents")
        .select(F.col("source").alias("project"))
        .distinct()
        .where(F.regexp_extract("project", r"(\d+)$", 1).cast("int") % 2 == 0)
    )
