"""Best console fragments of each hit, with the query's terms marked."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsift.functions.text import chunks, html_line_ends, pieces
from runsift.schemas import FRAGMENT_CHARS, KEY, MAX_FRAGMENTS
from runsift.sources.document_table import pick

# Consoles that one task cuts: their pieces take many times their stored bytes.
TASK_CONSOLES = 1000


def highlight_terms(analysed: DataFrame) -> DataFrame:
    """(qid, terms): the distinct terms of a query's positive clauses, whatever their field.

    In job mode the clauses are those of the rest, so the job word is not marked.
    """
    positive = F.filter("clauses", lambda c: c["occur"] != "must_not")
    return analysed.where("valid").select(
        "qid", F.array_distinct(F.flatten(F.transform(positive, lambda c: c["terms"]))).alias("terms")
    )


def fragment_table(docs: DataFrame, tasks: int | None = None) -> DataFrame:
    """(project, number, frag, parts): console text in fragments of about FRAGMENT_CHARS.

    A piece belongs to the fragment its end falls into. One document is one group, as it is one
    row of the input. ``tasks`` share the cutting; by the small consoles alone, Spark would take too few.
    """
    texts = docs.where(F.col("c").isNotNull()).select(*KEY, "c")
    spread = texts.repartition(tasks, *KEY) if tasks else texts.repartition(*KEY)
    parts = (
        spread
        .select(*KEY, F.posexplode(chunks(F.col("c"))).alias("chunk_no", "chunk"))
        .select(*KEY, "chunk_no", F.posexplode(pieces(F.col("chunk"))).alias("i", "piece"))
    )
    so_far = (
        Window.partitionBy(*KEY)
        .orderBy("chunk_no", "i")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = parts.withColumn("end", F.sum(F.length("piece")).over(so_far))
    return (
        placed.withColumn("frag", F.floor(F.col("end") / FRAGMENT_CHARS).cast("int"))
        .groupBy(*KEY, "frag")
        .agg(F.array_sort(F.collect_list(F.struct("end", "piece"))).alias("s"))
        .select(*KEY, "frag", F.col("s.piece").alias("parts"))
    )


def best_fragments(
    hits: DataFrame,
    docs: DataFrame,
    terms: DataFrame,
    small: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """(qid, project, number, fragments): up to five best fragments, touching ones joined.

    Only the consoles of hits are cut. ``small`` says that the hits were bounded by a counted
    query table and may be broadcast.
    """
    wanted = hits.select("qid", *KEY).join(F.broadcast(terms) if small else terms, "qid")
    keys = wanted.select(*KEY).distinct()
    own = [*KEY, "dp", "c"] if parts else [*KEY, "c"]
    consoles = pick(docs.select(*own), keys, "left_semi", small, parts)
    tasks = max(1, math.ceil(keys.count() / TASK_CONSOLES))
    offered = fragment_table(consoles, tasks).join(F.broadcast(wanted) if small else wanted, KEY)
    scored = offered.where(F.arrays_overlap("parts", "terms")).withColumn(
        "score", F.size(F.array_intersect("parts", "terms"))
    )
    best = Window.partitionBy("qid", *KEY).orderBy(F.desc("score"), "frag")
    chosen = (
        scored.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= MAX_FRAGMENTS)
        .select(
            "qid", *KEY, "frag", "place",
            F.array_join(
                F.transform(
                    "parts",
                    lambda p: F.when(
                        F.array_contains("terms", p), F.concat(F.lit("<B>"), p, F.lit("</B>"))
                    ).otherwise(p),
                ),
                "",
            ).alias("text"),
        )
    )
    in_text = Window.partitionBy("qid", *KEY).orderBy("frag")
    joined = (
        chosen.withColumn("island", F.col("frag") - F.row_number().over(in_text))
        .groupBy("qid", *KEY, "island")
        .agg(
            F.min("place").alias("place"),
            F.array_sort(F.collect_list(F.struct("frag", "text"))).alias("s"),
        )
        .withColumn("text", F.array_join(F.col("s.text"), ""))
    )
    return joined.groupBy("qid", *KEY).agg(
        F.array_sort(F.collect_list(F.struct("place", "text"))).alias("s")
    ).select("qid", *KEY, F.col("s.text").alias("fragments"))


def display_fragments(fragments):
    """Line ends as <br/>."""
    return F.transform(fragments, html_line_ends)
