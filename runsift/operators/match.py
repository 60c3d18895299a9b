"""Query terms against postings: which documents match, with their score."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.operators import scoring
from runsift.operators.queryterms import JOB, MUST, MUST_NOT, SHOULD
from runsift.operators.scoring import ASKED, score_slices
from runsift.schemas import BM25_B, BM25_K1, KEY, SCORE_DECIMALS, TOKEN
from runsift.session import BROADCAST_LIMIT_BYTES, written
from runsift.sources.index_tables import DIRECTORY_WORDS, SearchIndex, holding, term_part

# Bytes one query term takes as a broadcast row, hash table overhead included.
_TERM_ROW_BYTES = 160


@dataclass(frozen=True)
class QuerySize:
    """Counted size of a query table."""

    n_queries: int
    n_words: int
    n_bytes: int

    @classmethod
    def of(cls, queries: DataFrame) -> QuerySize:
        row = queries.agg(
            F.count(F.lit(1)),
            F.sum(F.regexp_count("q", F.lit(TOKEN))),
            F.sum(F.octet_length("q")),
        ).first()
        return cls(row[0], row[1] or 0, row[2] or 0)

    def small(self, n_fields: int, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
        rows = self.n_queries + self.n_words * max(n_fields, 1)
        return rows * _TERM_ROW_BYTES + self.n_bytes * n_fields <= limit


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def term_weight(tf: Column, dl: Column, avg_len: Column) -> Column:
    return tf / (tf + BM25_K1 * (1 - BM25_B + BM25_B * dl / avg_len))


def asked_words(terms: DataFrame, small: bool, column: str = "term") -> list[str] | None:
    """The words of a counted small query table if they are few enough for the index's directory; then
    scans read only pages that may hold one of them."""
    if not small:
        return None
    found = [row[0] for row in terms.select(column).distinct().limit(DIRECTORY_WORDS + 1).collect()]
    return found if len(found) <= DIRECTORY_WORDS else None


def known_terms(
    terms: DataFrame, index: SearchIndex, small: bool, words: list[str] | None = None
) -> DataFrame:
    """Add df, the documents with a term in a field; terms that occur nowhere drop out."""
    asked = F.broadcast(terms) if small else terms
    parts = [holding(p, "term", words).join(asked, ["tp", "field", "term"]) for p in index.term_stat_parts()]
    found = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        same = [c for c in found.columns if c != "df"]
        found = found.groupBy(*same).agg(F.sum("df").alias("df")).where("df > 0")
    return found


def weighted_terms(
    terms: DataFrame, index: SearchIndex, small: bool, words: list[str] | None = None
) -> DataFrame:
    """Add idf and avg_len to query terms; terms that occur nowhere drop out."""
    placed = terms
    if "tp" not in terms.columns:
        placed = terms.withColumn("tp", term_part(F.col("term"), index.term_parts))
    return with_weights(known_terms(placed.where("term != ''"), index, small, words), index)


def with_weights(terms: DataFrame, index: SearchIndex) -> DataFrame:
    """Replace a term's document count by its idf and the mean length of its field."""
    # One row per field, so its size does not grow with the data.
    stats = F.broadcast(index.field_stats)
    return (
        terms.join(stats, "field")
        .withColumn("idf", idf(F.col("n_docs"), F.col("df")))
        .drop("df", "n_docs")
    )


def term_hits(
    weighted: DataFrame,
    index: SearchIndex,
    small: bool,
    words: list[str] | None = None,
    bucketed: bool = True,
) -> DataFrame:
    """Join query terms to their postings. ``words`` are all terms asked for, if those are few; who
    spreads the postings by document needs no buckets.

    A measured small query table is broadcast: postings stay where they are and only the term
    partitions asked for are read. Otherwise both sides shuffle by term, and adaptive execution
    splits the partitions of common terms, on either side.
    """
    on = ["tp", "field", "term"]
    asked = weighted.where("term != ''")
    asked = F.broadcast(asked) if small else asked
    parts = [holding(p, "term", words).join(asked, on) for p in index.posting_parts(bucketed)]
    return reduce(DataFrame.unionByName, parts)


def score_documents(hits: DataFrame) -> DataFrame:
    """(qid, project, number, score): documents that satisfy their query, with the BM25 sum.

    All three groupings contain the document key, by which postings are bucketed.
    """
    clause = ["qid", *KEY, "n_must", "job_mode", "clause_no", "occur", "n_terms"]
    weight = F.col("idf") * term_weight(F.col("tf"), F.col("dl"), F.col("avg_len"))
    per_term = hits.groupBy(*clause, "term_no").agg(F.sum(weight).alias("weight"))
    per_clause = (
        per_term.groupBy(*clause)
        .agg(F.count(F.lit(1)).alias("n_found"), F.sum("weight").alias("weight"))
        .where("n_found = n_terms")
    )

    def met(kind: int) -> Column:
        return F.count_if(F.col("occur") == kind)

    return (
        per_clause.groupBy("qid", *KEY, "n_must", "job_mode")
        .agg(
            met(MUST).alias("must"),
            met(SHOULD).alias("should"),
            met(MUST_NOT).alias("must_not"),
            met(JOB).alias("job"),
            F.sum(F.when(F.col("occur") != MUST_NOT, F.col("weight"))).alias("total"),
        )
        .where(
            "must_not = 0 AND must = n_must AND (n_must > 0 OR should > 0)"
            " AND (job = 1 OR NOT job_mode)"
        )
        .select("qid", *KEY, F.round("total", SCORE_DECIMALS).alias("score"))
    )


def score_asked(
    asked: DataFrame, index: SearchIndex, words: list[str] | None = None
) -> DataFrame:
    """(qid, project, number, score) of measured query terms (ASKED, tp, field, term, df): the postings of each word
    are weighted and spread once, however many queries ask for it."""
    on = ["tp", "field", "term"]
    asked = written(asked.select(*ASKED, *on, "df"), "asked")
    n_pairs = asked.agg(F.sum("df")).first()[0] or 0
    if n_pairs <= scoring.TASK_POSTINGS * index.doc_buckets:
        # So few that the buckets are slices enough: nothing is shuffled.
        return score_documents(term_hits(with_weights(asked, index), index, True, words))
    listed = asked.groupBy(*on).agg(F.max("df").alias("df")).withColumn("word", F.monotonically_increasing_id())
    listed = written(listed, "asked-words")
    n_postings = listed.agg(F.sum("df")).first()[0] or 0
    hits = term_hits(with_weights(listed, index), index, True, words, bucketed=False)
    weight = F.col("idf") * term_weight(F.col("tf"), F.col("dl"), F.col("avg_len"))
    numbered = asked.join(F.broadcast(listed.drop("df")), on).select(*ASKED, "word")
    return score_slices(hits.select(*KEY, "word", weight.alias("weight")), numbered, n_postings)


def match(terms: DataFrame, index: SearchIndex, small: bool) -> DataFrame:
    """(qid, project, number, score) of every matching document, unranked."""
    words = asked_words(terms, small)
    if not small:
        return score_documents(term_hits(weighted_terms(terms, index, small, words), index, small, words))
    placed = terms.withColumn("tp", term_part(F.col("term"), index.term_parts))
    return score_asked(known_terms(placed.where("term != ''"), index, small, words), index, words)
