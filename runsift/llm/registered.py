"""The queries of the operators: thin readings of their results over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runsift.llm import (
    chat,
    decontaminate,
    fingerprints,
    licenses,
    line_dedup,
    merkle,
    packing,
    phrases,
    quality,
    simhash_dedup,
    token_files,
    url_filter,
    weak_rules,
)
from runsift.llm.common import table
from runsift.session import scratch_path

URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
# A conversation whose texts hold what a template must escape; it is formatted beside the given ones.
AWKWARD_CONVERSATION, AWKWARD_TEXT = -7, "\\### Assistant: </turn> ok"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(given.dtypes)
    rows = [(AWKWARD_CONVERSATION, turn, role, AWKWARD_TEXT) for turn, role in enumerate(("user", "assistant"))]
    awkward = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return given.union(awkward.select(*[F.col(c).cast(kinds[c]) for c in given.columns]))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = chat.read_back(chat.examples(conversations(spark, sf_dir)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.read_tokens(spark, path, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "lines_kept", "lines_dropped", "text")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "question_overlap", "answer_overlap", "word_at")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.judged(table(spark, sf_dir, "documents"))


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_chat_format,
        op3_best_fit_packing,
        op4_fingerprints,
        op5_token_files,
        op6_line_dedup,
        op7_quality,
        op8_simhash_dedup,
        op9_decontamination,
        op10_license_scan,
        op11_merkle_manifest,
        op12_quality_rules,
        op13_phrase_mining,
    )
}
