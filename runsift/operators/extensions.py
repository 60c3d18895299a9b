"""Built-in extension texts: failed tests and artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsift.schemas import KEY


def ordered_concat(rows: DataFrame, order: str, piece) -> DataFrame:
    """(project, number, text): the pieces of each run joined in ``order``.

    A run's pieces form one text value in the end, so the group is bounded by that value.
    """
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("piece"))))
    return rows.groupBy(*KEY).agg(F.array_join(F.transform(parts, lambda s: s["piece"]), "").alias("text"))


def _or_null_word(name: str):
    return F.coalesce(F.col(name), F.lit("null"))


def failed_test_text(failed_tests: DataFrame):
    """Extension: title and error details of each failed test, a line each; '' without any."""

    def text(runs: DataFrame) -> DataFrame:
        piece = F.concat(_or_null_word("title"), F.lit("\n"), _or_null_word("error_details"), F.lit("\n"))
        per_run = ordered_concat(failed_tests, "seq", piece)
        keys = runs.select(*KEY)
        return keys.join(per_run, KEY, "left").select(*KEY, F.coalesce("text", F.lit("")).alias("text"))

    return text


def artifact_text(artifacts: DataFrame):
    """Extension: path and content of each artifact, blanks between."""

    def text(runs: DataFrame) -> DataFrame:
        piece = F.concat(F.col("path"), F.lit(" "), F.col("content"), F.lit(" "))
        per_run = ordered_concat(artifacts, "path", piece)
        keys = runs.select(*KEY)
        return keys.join(per_run, KEY, "left").select(*KEY, F.coalesce("text", F.lit("")).alias("text"))

    return text
