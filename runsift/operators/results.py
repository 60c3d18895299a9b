"""From ranked hits to result pages: names, de-duplication, order, URLs, visibility, unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsift.functions.text import count_label, hit_url
from runsift.operators.documents import search_name
from runsift.schemas import KEY, PAGE_SIZE
from runsift.sources.document_table import pick


def with_names(
    hits: DataFrame, docs: DataFrame, small: bool = False, parts: int | None = None
) -> DataFrame:
    """Add search_name from the stored document; only narrow columns are read."""
    own = [*KEY, "dp"] if parts else KEY
    names = docs.select(*own, search_name(F.col("j"), F.col("d")).alias("search_name"))
    return pick(names, hits, "inner", small, parts)


def dedupe_page(paged: DataFrame) -> DataFrame:
    """One hit per page and name, the lowest ranked; a group is at most one page."""
    same = Window.partitionBy("qid", "page", "search_name").orderBy(F.desc("rank"))
    return paged.withColumn("_c", F.row_number().over(same)).where("_c = 1").drop("_c")


def order_page(paged: DataFrame) -> DataFrame:
    """pos_in_page: names in descending string order, not by score."""
    by_name = Window.partitionBy("qid", "page").orderBy(F.desc_nulls_last("search_name"))
    return paged.withColumn("pos_in_page", F.row_number().over(by_name))


def with_urls(hits: DataFrame, runs: DataFrame, root: str, small: bool = False) -> DataFrame:
    """Add the run's URL; a hit whose run is gone drops out."""
    urls = runs.select(*KEY, hit_url(F.lit(root), F.col("url")).alias("url"))
    return urls.join(F.broadcast(hits) if small else hits, KEY)


def orphan_documents(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Documents without a run any more."""
    return docs.select(*KEY).join(runs.select(*KEY), KEY, "left_anti")


def visible_hits(hits: DataFrame, visible: DataFrame, user: str | None = None) -> DataFrame:
    """Keep hits of projects the user may see; ``visible`` is (user, project) or (project)."""
    allowed = visible.where(F.col("user") == user) if user is not None else visible
    return hits.join(allowed.select("project").distinct(), "project", "left_semi")


def page_sizes(paged: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(qid, page, n_hits, label): the label reads ``100+`` for a full page."""
    counted = paged.groupBy("qid", "page").agg(F.count(F.lit(1)).alias("n_hits"))
    return counted.withColumn("label", count_label(F.col("n_hits"), page_size))


def name_hits(queries: DataFrame, jobs: DataFrame) -> DataFrame:
    """(qid, search_name): jobs whose name or full name equals the query."""
    q = queries.select("qid", F.trim("q").alias("q"))
    by_full = jobs.join(q, jobs.full_name == q.q).select("qid", F.col("full_name").alias("search_name"))
    other = jobs.where("name != full_name")
    by_name = other.join(q, other.name == q.q).select("qid", F.col("full_name").alias("search_name"))
    return by_full.unionByName(by_name)


def name_suggestions(queries: DataFrame, jobs: DataFrame) -> DataFrame:
    """(qid, search_name): jobs whose name starts with the query.

    Every prefix of a name is a key, so this is an equality join and not a comparison of all pairs.
    """
    prefixes = jobs.select(
        F.col("full_name").alias("search_name"),
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.length("name"), F.lit(1))),
                lambda n: F.substr(F.col("name"), F.lit(1), n),
            )
        ).alias("q"),
    )
    asked = queries.select("qid", F.trim("q").alias("q"))
    return prefixes.join(asked, "q").select("qid", "search_name")


def names_then_text(names: DataFrame, text_hits: DataFrame) -> DataFrame:
    """Name hits before text hits; name hits carry no console."""
    first = names.withColumn("src", F.lit(0)).withColumn("show_console", F.lit(False))
    return first.unionByName(text_hits.withColumn("src", F.lit(1)), allowMissingColumns=True)


def suggestions(names: DataFrame, paged: DataFrame) -> DataFrame:
    """Names and first-page hits; there is never more to load."""
    page_one = paged.where("page = 1").select("qid", "search_name")
    return names.select("qid", "search_name").unionByName(page_one).withColumn("has_more", F.lit(False))
