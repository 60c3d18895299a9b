"""Search strings as rows: pieces, operators, clauses, job mode.

The language is flat, so everything about one query is computed inside its row; nothing shuffles
until clauses meet an index.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.functions.text import Tokenizer, escaped_query, strip, tokens
from runsift.schemas import SPECIAL_CHARS
from runsift.session import written

# Bytes of queries that one task parses.
TASK_QUERY_BYTES = 16 * 1024
_OPERATORS = ("AND", "OR", "NOT")

# The words of an escaped query: sign, field, text, and the operator it is, if any.
_WORDS = rf"""
    transform(
        arrays_zip(
            regexp_extract_all(_escaped, r'(?:((?:[^\s\\:]|\\.)+):\s*)?(\S+)', 1),
            regexp_extract_all(_escaped, r'(?:((?:[^\s\\:]|\\.)+):\s*)?(\S+)', 2)
        ),
        p -> named_struct(
            'sign', regexp_extract(p['0'], r'^[+\-!]', 0),
            'field', regexp_replace(p['0'], r'^[+\-!]', ''),
            'text', p['1'],
            'op', if(p['0'] = '' AND p['1'] IN ('AND', 'OR', 'NOT'), p['1'], NULL)
        )
    )"""

# True for each word the query language rejects; a query with such a word has no hits. A word may
# not hold a special character that is not escaped, an operator may not carry a field, and
# operators need words beside them.
_BAD = rf"""
    transform(_words, (w, i) ->
        regexp_replace(w.text, r'\\.', '') RLIKE r'[{SPECIAL_CHARS}]'
        OR regexp_replace(w.field, r'\\.', '') RLIKE r'[{SPECIAL_CHARS}]'
        OR (w.sign != '' AND w.field = '')
        OR (w.op IS NULL AND w.text IN ('AND', 'OR', 'NOT'))
        OR (w.op IN ('AND', 'OR') AND (i = 0 OR get(_words, i - 1).op IS NOT NULL))
        OR (get(_words, i - 1).op <=> 'NOT' AND (w.op <=> 'NOT' OR w.sign != ''))
        OR (w.op IS NOT NULL AND i = size(_words) - 1)
    )"""

# Words that are no operators and have tokens, with the operators before them folded in.
_RAW = """
    filter(
        transform(_words, (w, i) -> named_struct(
            'op', w.op,
            'neg', get(_words, i - 1).op <=> 'NOT' OR w.sign IN ('-', '!'),
            'conj', nullif(if(get(_words, i - 1).op <=> 'NOT',
                              get(_words, i - 2).op, get(_words, i - 1).op), 'NOT'),
            'field', nullif(w.field, ''),
            'terms', _terms[i]
        )),
        c -> c.op IS NULL AND size(c.terms) > 0
    )"""

# AND is the default between words.
_CLAUSES = """
    transform(_raw, (c, i) -> named_struct(
        'clause_no', i,
        'occur', CASE WHEN c.neg THEN 'must_not'
                      WHEN get(_raw, i + 1).conj = 'OR' THEN 'should'
                      WHEN get(_raw, i + 1).conj = 'AND' THEN 'must'
                      WHEN c.conj = 'OR' THEN 'should'
                      ELSE 'must' END,
        'field', c.field,
        'terms', c.terms
    ))"""


def parse(queries: DataFrame, source: str, prefix: str = "", tokenizer: Tokenizer = tokens) -> DataFrame:
    """Add ``<prefix>escaped``, ``<prefix>valid`` and ``<prefix>clauses`` for a query column."""
    return (
        queries.withColumn("_escaped", escaped_query(F.col(source)))
        .withColumn("_words", F.expr(_WORDS))
        .withColumn(
            "_terms",
            F.transform("_words", lambda w: F.array_distinct(tokenizer(w["text"]))),
        )
        .withColumn("_raw", F.expr(_RAW))
        .select(
            *queries.columns,
            F.col("_escaped").alias(f"{prefix}escaped"),
            F.expr(f"size(_words) > 0 AND NOT exists({_BAD}, b -> b <=> true)").alias(f"{prefix}valid"),
            F.expr(_CLAUSES).alias(f"{prefix}clauses"),
        )
    )


def first_word_and_rest(q: Column) -> Column:
    return F.split(strip(q), r"\s+", 2)


def with_job_word(queries: DataFrame, tokenizer: Tokenizer = tokens) -> DataFrame:
    """Add _rest and job_terms: the tokens of the first word, none if it cannot be a job name.

    That takes two words, the first of them no operator.
    """
    split = queries.withColumn("_w", first_word_and_rest(F.col("q")))
    first = F.get("_w", F.lit(0))
    may_be = (F.size("_w") == 2) & ~first.isin(*_OPERATORS)
    return split.select(
        *queries.columns,
        F.coalesce(F.get("_w", F.lit(1)), F.lit("")).alias("_rest"),
        F.array_distinct(tokenizer(F.when(may_be, first).otherwise(F.lit("")))).alias("job_terms"),
    )


def known_jobs(named: DataFrame, jobs: DataFrame, small: bool = False) -> DataFrame:
    """qids whose first word names a job that has documents: all its tokens occur in one job name."""
    asked = named.select(
        "qid", F.size("job_terms").alias("n_terms"), F.explode("job_terms").alias("term")
    )
    terms = jobs.select("project", F.explode("terms").alias("term"))
    return (
        terms.join(F.broadcast(asked) if small else asked, "term")
        .groupBy("qid", "project", "n_terms")
        .agg(F.count(F.lit(1)).alias("n_found"))
        .where("n_found = n_terms")
        .select("qid")
        .distinct()
    )


def analyse(
    queries: DataFrame,
    jobs: DataFrame | None = None,
    tokenizer: Tokenizer = tokens,
    small: bool = False,
    n_bytes: int = 0,
) -> DataFrame:
    """One row per query: escaped, valid, job_mode, job_terms, clauses in force, show_console.

    In job mode the first word restricts the job and the rest is the query proper. ``small`` says
    that the query table was measured and may be broadcast, ``n_bytes`` how much text it holds: long
    queries are few rows, so they are spread before they are parsed. The result is written once: several
    steps read it, and none of their filters may pull the parsing along.
    """
    named = with_job_word(queries, tokenizer)
    if jobs is None:
        flagged = named.withColumn("_job", F.lit(False))
    else:
        known = known_jobs(named, jobs, small).withColumn("_job", F.lit(True))
        flagged = named.join(F.broadcast(known) if small else known, "qid", "left")
    tasks = math.ceil(n_bytes / TASK_QUERY_BYTES)
    flagged = flagged.repartition(tasks) if tasks > 1 else flagged
    parsed = parse(parse(flagged, "q", "", tokenizer), "_rest", "rest_", tokenizer)
    job_mode = F.coalesce("_job", F.lit(False)) & F.col("valid") & F.col("rest_valid")
    chosen = parsed.withColumn("job_mode", job_mode).select(
        *queries.columns,
        "escaped",
        "valid",
        "job_mode",
        F.when(F.col("job_mode"), F.col("job_terms")).alias("job_terms"),
        F.when(F.col("job_mode"), F.col("rest_clauses")).otherwise(F.col("clauses")).alias("clauses"),
    )
    uses_console = F.exists("clauses", lambda c: c["field"].isNull() | (c["field"] == "c"))
    return written(chosen.withColumn("show_console", F.col("valid") & uses_console), "queries")


# How clauses act, as numbers: they are part of every grouping key in matching.
MUST, SHOULD, MUST_NOT, JOB = 0, 1, 2, 3


def clause_terms(analysed: DataFrame, default_keys: list[str] | tuple[str, ...]) -> DataFrame:
    """(qid, n_must, job_mode, clause_no, occur, n_terms, field, term_no, term) of valid queries.

    The job word is clause -1. A clause without a field is offered to every default field.
    """
    n_must = F.size(F.filter("clauses", lambda c: c["occur"] == "must"))
    defaults = F.array(*[F.lit(k) for k in default_keys])
    code = (
        F.when(F.col("c.occur") == "must", MUST)
        .when(F.col("c.occur") == "should", SHOULD)
        .otherwise(MUST_NOT)
    )
    fields = F.when(F.col("c.field").isNull(), defaults).otherwise(F.array("c.field"))
    valid = analysed.where("valid").withColumn("n_must", n_must)
    body = valid.select("qid", "n_must", "job_mode", F.explode("clauses").alias("c")).select(
        "qid",
        "n_must",
        "job_mode",
        F.col("c.clause_no").alias("clause_no"),
        code.alias("occur"),
        F.col("c.terms").alias("terms"),
        F.explode(fields).alias("field"),
    )
    job = valid.where("job_mode").select(
        "qid",
        "n_must",
        "job_mode",
        F.lit(-1).alias("clause_no"),
        F.lit(JOB).alias("occur"),
        F.col("job_terms").alias("terms"),
        F.lit("j").alias("field"),
    )
    return body.unionByName(job).select(
        "qid",
        "n_must",
        "job_mode",
        "clause_no",
        "occur",
        F.size("terms").alias("n_terms"),
        "field",
        F.posexplode("terms").alias("term_no", "term"),
    )
