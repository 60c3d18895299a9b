"""Runs to documents: field extraction, extension text, hit names."""

from __future__ import annotations

import logging
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runsift.fields import FieldRegistry
from runsift.functions.text import parameter_text
from runsift.schemas import KEY
from runsift.session import written

log = logging.getLogger(__name__)


def extract_fields(runs: DataFrame) -> DataFrame:
    """The five built-in fields of every run; a missing source value gives a null field."""
    return runs.select(
        *KEY,
        F.col("project").alias("j"),
        F.col("number").cast("string").alias("n"),
        F.col("display_name").alias("d"),
        parameter_text(F.col("parameters")).alias("p"),
        F.col("console").alias("c"),
    )


def add_extension(docs: DataFrame, runs: DataFrame, keyword: str, text) -> DataFrame:
    """Left join one extension's text. An extension that cannot be planned loses only its own field."""
    try:
        extra = text(runs).select(*KEY, F.col("text").cast("string").alias(keyword))
    except Exception as error:  # noqa: BLE001 - any failure of foreign code costs its field only
        log.warning("extension %s failed: %s", keyword, error)
        return docs.withColumn(keyword, F.lit(None).cast("string"))
    return docs.join(extra, KEY, "left")


def build_documents(runs: DataFrame, registry: FieldRegistry | None = None) -> DataFrame:
    """One row per run with a nullable column per field."""
    docs = extract_fields(runs)
    for field in registry.extensions if registry else []:
        docs = add_extension(docs, runs, field.key, field.text)
    return docs


@dataclass(frozen=True)
class ExtensionReport:
    """What came of one extension: texts stored, values that failed, and why the whole failed, if it did."""

    keyword: str
    n_texts: int
    n_failed: int
    error: str | None = None


def build_documents_isolated(
    runs: DataFrame, registry: FieldRegistry
) -> tuple[DataFrame, list[ExtensionReport]]:
    """As `build_documents`, with every extension run by itself first.

    Each extension's text is written in a job of its own, and counted while it is written. A value that
    fails loses its own text and leaves its reason in the column ``<keyword>_error``; if the job as a
    whole fails, all runs lose that field with the reason of the failure. Other fields are not touched.
    """
    docs, reports = extract_fields(runs), []
    for field in registry.extensions:
        text, report = _isolated(field.text, runs, field.key)
        docs, reports = docs.join(text, KEY, "left"), [*reports, report]
        if report.error is not None:
            docs = docs.withColumn(f"{field.key}_error", F.lit(report.error))
    return docs, reports


def _isolated(text, runs: DataFrame, keyword: str) -> tuple[DataFrame, ExtensionReport]:
    error = f"{keyword}_error"
    seen = Observation(f"extension {keyword}")
    try:
        found = text(runs)
        reason = F.col("error") if "error" in found.columns else F.lit(None)
        rows = found.select(*KEY, F.col("text").cast("string").alias(keyword), reason.cast("string").alias(error))
        counted = rows.observe(
            seen, F.count(keyword).alias("n_texts"), F.count(error).alias("n_failed")
        )
        stored = written(counted, f"extension-{keyword}")
        counts = seen.get
        return stored, ExtensionReport(keyword, counts["n_texts"], counts["n_failed"])
    except Exception as failure:  # noqa: BLE001 - any failure of foreign code costs its field only
        log.warning("extension %s failed: %s", keyword, failure)
        none = F.lit(None).cast("string")
        empty = runs.select(*KEY, none.alias(keyword), none.alias(error)).limit(0)
        return empty, ExtensionReport(keyword, 0, 0, type(failure).__name__)


def extension_report(reports: list[ExtensionReport], runs: DataFrame) -> DataFrame:
    """(keyword, n_texts, n_failed, error): one row per extension."""
    schema = "keyword string, n_texts bigint, n_failed bigint, error string"
    rows = [(r.keyword, r.n_texts, r.n_failed, r.error) for r in reports]
    return runs.sparkSession.createDataFrame(rows, schema)


def stored_documents(docs: DataFrame, registry: FieldRegistry) -> DataFrame:
    """What is kept after indexing: searchable-only fields are dropped."""
    return docs.select(*KEY, *[k for k in registry.stored_keys if k in docs.columns])


def search_name(docs_j: Column, docs_d: Column) -> Column:
    return F.concat(docs_j, docs_d)


def guarded_text(extract):
    """A pandas UDF around foreign text extraction: a value that raises becomes null."""

    def one(value):
        try:
            return None if value is None else extract(value)
        except Exception:  # noqa: BLE001
            return None

    @F.pandas_udf(T.StringType())
    def text(values: pd.Series) -> pd.Series:
        return values.map(one)

    return text


def guarded_extraction(extract):
    """As `guarded_text`, with the reason beside the text: struct<text, error>."""

    def one(value):
        try:
            return (None if value is None else extract(value), None)
        except Exception as failure:  # noqa: BLE001
            return (None, type(failure).__name__)

    @F.pandas_udf("text string, error string")
    def text(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(v) for v in values], columns=["text", "error"], dtype=object)

    return text
