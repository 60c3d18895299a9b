"""Readers for console logs and artifact files."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runsift.schemas import KEY
from runsift.session import written


def decode_text(content: Column, charset: str = "UTF-8") -> Column:
    """Bytes to text; malformed bytes become U+FFFD and never fail the job."""
    if charset.upper() == "UTF-8":
        return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(
            F.make_valid_utf8(content.cast("string"))
        )
    if charset.upper() == "ISO-8859-1":
        return F.decode(content, "ISO-8859-1")
    "".encode(charset)  # an unknown charset fails here and not in a task

    @F.pandas_udf(T.StringType())
    def decoded(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else bytes(b).decode(charset, "replace"))

    return decoded(content)


def ant_regex(pattern: str) -> str:
    """A file pattern (``**`` any folders, ``*`` and ``?`` inside one name) as a regex."""
    if pattern.endswith("/"):
        pattern += "**"
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:[^/]+/)*", i + 3
        elif pattern.startswith("/**", i) and i + 3 == len(pattern):
            out, i = out + "(?:/.*)?", i + 3
        elif pattern.startswith("**", i):
            out, i = out + ".*", i + 2
        else:
            c = pattern[i]
            simple = {"*": "[^/]*", "?": "[^/]"}.get(c)
            out += simple if simple else (c if c.isalnum() or c in "/_" else "\\" + c)
            i += 1
    return f"^{out}$"


def path_patterns(patterns: str | None) -> list[str]:
    """Comma- or blank-separated patterns."""
    return [p for p in (patterns or "").replace(",", " ").split() if p]


def path_selected(path: Column, includes: str, excludes: str | None = None) -> Column:
    """True for paths that fit an include pattern and no exclude pattern."""

    def any_of(patterns: list[str]) -> Column:
        fits = F.lit(False)
        for p in patterns:
            fits = fits | path.rlike(ant_regex(p))
        return fits

    return any_of(path_patterns(includes)) & ~any_of(path_patterns(excludes))


def read_files(spark: SparkSession, root: str, name_filter: str | None = None) -> DataFrame:
    """(path relative to root, content) of all files under a folder, read in parallel."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    files = reader.option("ignoreCorruptFiles", "true").load(root)
    return files.select(_relative(F.col("path"), root).alias("path"), "content")


_STORE = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?/*"


def _relative(path: Column, root: str) -> Column:
    """A path below the root, whatever scheme and host either of them names."""
    below = "/" + re.sub(_STORE, "/", root).strip("/")
    plain = F.translate(F.regexp_replace(path, _STORE, "/"), "\\", "/")
    inside = F.substring(plain, F.lit(len(below.rstrip("/")) + 2), F.length(plain))
    return F.when(F.startswith(plain, F.lit(below.rstrip("/") + "/")), inside).otherwise(plain)


_LOG = r"^(.*)/(\d+)/log$"


def _run_of(path: Column) -> list[Column]:
    return [
        F.regexp_extract(path, _LOG, 1).alias("project"),
        F.regexp_extract(path, _LOG, 2).cast("bigint").alias("number"),
    ]


def read_console_logs(spark: SparkSession, root: str, charset: str = "UTF-8") -> DataFrame:
    """(project, number, console) from ``<project>/<number>/log`` files.

    A log that is listed but cannot be read keeps its run, with a null console. What was read is written
    to the shared folder, so that only keys are compared with the listing and no console is shuffled.
    A log is one value; ``read_log_lines`` reads logs of any size.
    """
    files = read_files(spark, root, "log").where(F.col("path").rlike(_LOG))
    listed = files.select(*_run_of(F.col("path")))
    read = files.select(*_run_of(F.col("path")), decode_text(F.col("content"), charset).alias("console"))
    read = written(read, "consoles")
    unread = listed.join(read.select(*KEY), KEY, "left_anti")
    return read.unionByName(unread.withColumn("console", F.lit(None).cast("string")))


def read_log_lines(spark: SparkSession, root: str) -> DataFrame:
    """(project, number, field, text): the lines of UTF-8 logs, as ``pieces`` of an index take them.

    Files are split between tasks, so a log may be larger than any row or task.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "log")
    lines = reader.option("lineSep", "\n").text(root)
    path = _relative(F.col("_metadata.file_path"), root)
    rows = lines.select(path.alias("path"), F.make_valid_utf8("value").alias("text"))
    return rows.where(F.col("path").rlike(_LOG)).select(*_run_of(F.col("path")), F.lit("c").alias("field"), "text")


def read_artifacts(
    spark: SparkSession,
    root: str,
    includes: str,
    excludes: str | None = None,
    charset: str = "UTF-8",
) -> DataFrame:
    """(project, number, path, content) from ``<project>/<number>/archive/<path>`` files."""
    at = r"^(.*?)/(\d+)/archive/(.+)$"
    files = read_files(spark, root).where(F.col("path").rlike(at)).select(
        F.regexp_extract("path", at, 1).alias("project"),
        F.regexp_extract("path", at, 2).cast("bigint").alias("number"),
        F.regexp_extract("path", at, 3).alias("file"),
        "content",
    )
    return files.where(path_selected(F.col("file"), includes, excludes)).select(
        "project", "number", F.col("file").alias("path"),
        decode_text(F.col("content"), charset).alias("content"),
    )
