"""Token, postings and statistics tables derived from documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runsift.functions.text import Tokenizer, blocks, tokens
from runsift.operators.counting import count_tokens
from runsift.schemas import KEY

POSTING = [*KEY, "field", "term"]
# Tokens of one row on their way to be counted: batches of rows stay small whatever the texts.
LIST_TOKENS = 64


def field_text(docs: DataFrame, keys: Iterable[str]) -> DataFrame:
    """(project, number, field, text): one row per present field.

    Documents spread by key stay so, which an unpivot would not tell Spark.
    """
    fields = F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("text")) for k in keys])
    rows = docs.select(*KEY, F.explode(fields).alias("f")).select(*KEY, "f.field", "f.text")
    return rows.where(F.col("text").isNotNull())


def token_rows(
    texts: DataFrame,
    exact: Iterable[str] = (),
    tokenizer: Tokenizer = tokens,
    carried: Iterable[str] = (),
) -> DataFrame:
    """(project, number, field, carried, n_tokens, term, pos): one row per token; an exact field is one token."""
    own = [*KEY, "field", *carried]
    found = token_chunks(texts, exact, tokenizer, carried)
    rows = found.select(*own, "n_tokens", "base", F.posexplode("found").alias("i", "term"))
    return rows.select(*own, "n_tokens", "term", (F.col("base") + F.col("i")).alias("pos"))


def token_lists(
    texts: DataFrame,
    exact: Iterable[str] = (),
    tokenizer: Tokenizer = tokens,
    part: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """As `token_chunks`, in lists of at most LIST_TOKENS tokens, and the parts of the tokens if ``part`` gives them."""
    chunks = token_chunks(texts, exact, tokenizer)
    starts = F.when(F.size("found") > 0, F.sequence(F.lit(0), F.size("found") - 1, F.lit(LIST_TOKENS)))
    cut = chunks.select(*KEY, "field", "n_tokens", "base", "found", F.explode(starts).alias("at"))
    found = F.slice("found", F.col("at") + 1, F.lit(LIST_TOKENS)).alias("found")
    lists = cut.select(*KEY, "field", "n_tokens", (F.col("base") + F.col("at")).alias("base"), found)
    return lists if part is None else lists.withColumn("parts", F.transform("found", part))


def token_chunks(
    texts: DataFrame,
    exact: Iterable[str] = (),
    tokenizer: Tokenizer = tokens,
    carried: Iterable[str] = (),
) -> DataFrame:
    """(project, number, field, carried, n_tokens, base, found): the tokens of each chunk of a text in an array.

    ``texts`` is (project, number, field, text) and carried columns. n_tokens is the token count of the whole text, base
    the place of the chunk's first token in it from 0. Large texts are tokenised chunk by chunk, twice, so that their
    tokens are never held at once; an exact field, or a tokenizer that is not line-safe, always sees
    the whole text.
    """
    whole_text = F.col("field").isin(*exact)
    cut = F.when(whole_text, F.array("text")).otherwise(blocks(F.col("text"), tokenizer.line_safe))

    def found_in(chunk: Column) -> Column:
        whole = F.when(chunk != "", F.array(chunk)).otherwise(F.array().cast("array<string>"))
        return F.when(whole_text, whole).otherwise(tokenizer(chunk))

    def summed(sizes: Column) -> Column:
        return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda n, size: n + size)

    sizes = F.when(F.size("chunks") != 1, F.transform("chunks", lambda c: F.size(found_in(c))))
    # Tokens before each chunk; only texts of many chunks have them counted first.
    before = F.coalesce(
        F.transform("sizes", lambda _, i: summed(F.slice("sizes", F.lit(1), i))),
        F.array(F.lit(0).cast("bigint")),
    )
    own = [*KEY, "field", *carried]
    return (
        texts.select(*own, cut.alias("chunks"))
        .select(*own, "chunks", sizes.alias("sizes"))
        .select(
            *own,
            summed(F.col("sizes")).alias("n_chunked"),
            F.explode(F.arrays_zip(F.col("chunks").alias("text"), before.alias("base"))).alias("chunk"),
        )
        .select(*own, "n_chunked", "chunk.base", found_in(F.col("chunk.text")).alias("found"))
        .select(
            *own,
            F.coalesce("n_chunked", F.size("found")).cast("bigint").alias("n_tokens"),
            "base",
            "found",
        )
    )


def without_stop_words(rows: DataFrame, stop_words: DataFrame | None = None) -> DataFrame:
    """Drop tokens listed in a (term) table; with none given, every token stays."""
    return rows if stop_words is None else rows.join(stop_words.distinct(), "term", "left_anti")


def _places() -> Column:
    """The places of a term in its text, ascending. Stored, their differences are what takes space."""
    return F.array_sort(F.collect_list("pos")).alias("pos")


def postings(
    docs: DataFrame,
    keys: Iterable[str],
    exact: Iterable[str] = (),
    tokenizer: Tokenizer = tokens,
    stop_words: DataFrame | None = None,
    partitions: int | None = None,
    places: bool = True,
    part: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(project, number, field, term, tf, dl, pos); without ``places``, no pos.

    Documents are spread by key once and counted there, a run of documents at a time; who writes the
    rows by ``part``, term and field has little to sort. Stop words leave gaps between the places of
    the other words.
    """
    spread = docs.repartition(partitions, *KEY) if partitions else docs.repartition(*KEY)
    if stop_words is None:
        # Rows that share a key are one document.
        texts = field_text(spread.sortWithinPartitions(*KEY), keys)
        return count_tokens(token_lists(texts, exact, tokenizer, part), places)
    rows = token_rows(field_text(spread, keys), exact, tokenizer)
    tf = F.count(F.lit(1)).alias("tf")
    counted = without_stop_words(rows, stop_words).groupBy(*POSTING).agg(tf, _places())
    dl = F.sum("tf").over(Window.partitionBy(*KEY, "field"))
    return counted.select(*POSTING, "tf", dl.alias("dl"), *(["pos"] if places else []))


def piece_postings(
    pieces: DataFrame, exact: Iterable[str] = (), tokenizer: Tokenizer = tokens
) -> DataFrame:
    """Postings of fields whose text comes in many rows (project, number, field, text).

    The pieces are counted before they are brought together, so one run with very many of them is
    neither joined into one string nor tokenised in one task. Pieces have no order: each has places
    of its own, by the hash of its text, so a phrase never reaches from one into another.
    """
    apart = F.shiftleft(F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)), 32).alias("apart")
    found = token_rows(pieces.select(*KEY, "field", "text", apart), exact, tokenizer, ["apart"])
    placed = found.select(*POSTING, (F.col("apart") + F.col("pos")).alias("pos"))
    counted = placed.groupBy(*POSTING).agg(F.count(F.lit(1)).alias("tf"), _places())
    return counted.join(doc_lengths(counted), [*KEY, "field"]).select(*POSTING, "tf", "dl", "pos")


def term_stats(posting_rows: DataFrame) -> DataFrame:
    """(field, term, df)"""
    return posting_rows.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def doc_lengths(posting_rows: DataFrame) -> DataFrame:
    """(project, number, field, dl)"""
    return posting_rows.groupBy(*KEY, "field").agg(F.sum("tf").alias("dl"))


def field_stats(posting_rows: DataFrame) -> DataFrame:
    """(field, n_docs, avg_len): one row per field."""
    return (
        doc_lengths(posting_rows)
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("dl").alias("sum_len"))
        .select("field", "n_docs", (F.col("sum_len") / F.col("n_docs")).alias("avg_len"))
    )


def positions(docs: DataFrame, keys: Iterable[str], tokenizer: Tokenizer = tokens) -> DataFrame:
    """(project, number, field, term, pos): token positions counted through the whole text."""
    rows = token_rows(field_text(docs.repartition(*KEY), keys), (), tokenizer)
    return rows.select(*KEY, "field", "term", "pos")
