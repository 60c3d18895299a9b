"""Whole searches on small hand-made tables, with brute-force expectations."""

import math

import pytest
from pyspark.sql import functions as F

from runsift import FieldRegistry, SearchIndex, Searcher
from runsift.operators import documents as D
from runsift.operators import extensions as E
from runsift.operators import postings as P
from runsift.operators import predicates, rank
from runsift.schemas import RUNS
from runsift.session import scratch_path

LOGS = {
    ("app", 1): "build ok\nall tests passed",
    ("app", 2): "build failed: disk full\nretry failed",
    ("app test", 1): "disk check ok",
    ("folder/job", 7): "Build started\nbuild build build",
    ("web", 3): "nothing here",
}


@pytest.fixture(scope="module")
def runs(spark):
    rows = [
        (p, n, f"#{n}", [("branch", "main")], log, f"job/{p}/{n}/") for (p, n), log in LOGS.items()
    ]
    return spark.createDataFrame(rows, RUNS)


@pytest.fixture(scope="module")
def searcher(spark, runs):
    docs = D.build_documents(runs)
    return Searcher(SearchIndex.build(docs, scratch_path(spark, "t"), doc_buckets=4), docs)


def ask(spark, searcher, *queries, method="scored"):
    rows = spark.createDataFrame(list(enumerate(queries)), "qid bigint, q string")
    found = {}
    for r in getattr(searcher, method)(rows).collect():
        found.setdefault(r.qid, set()).add((r.project, r.number))
    return [found.get(i, set()) for i in range(len(queries))]


CASES = {
    "build": {("app", 1), ("app", 2), ("folder/job", 7)},
    "Build": {("folder/job", 7)},
    "build disk": {("app", 2)},
    "started OR here": {("folder/job", 7), ("web", 3)},
    "build NOT failed": {("app", 1), ("folder/job", 7)},
    "NOT build": set(),
    "c:ok j:app": {("app", 1), ("app test", 1)},
    "j:folder/job": {("folder/job", 7)},
    "n:7": {("folder/job", 7)},
    "7": {("folder/job", 7)},
    "zz:build": set(),
    "app ok": {("app", 1), ("app test", 1)},
    "app NOT ok": set(),
    "web build": set(),
    "main": set(LOGS),
    "p:main d:3": {("web", 3)},
    "buil*": set(),
    "build AND": set(),
    "c:http://x:80": set(),
}


def test_matches(spark, searcher):
    assert ask(spark, searcher, *CASES) == list(CASES.values())


def test_without_broadcast_the_result_is_the_same(spark, searcher):
    spread = Searcher(searcher.index, searcher.docs, broadcast_limit=0)
    assert ask(spark, spread, *CASES) == list(CASES.values())


def test_reopened_index(spark, searcher):
    again = SearchIndex.open(spark, searcher.index.path)
    spark.sql(f"DROP TABLE {again._table}")
    again = SearchIndex.open(spark, searcher.index.path)
    assert again.default_keys == ("j", "d", "p", "c")
    assert ask(spark, Searcher(again, searcher.docs), *CASES) == list(CASES.values())


def test_score_is_bm25(spark, searcher):
    rows = spark.createDataFrame([(0, "c:build")], "qid bigint, q string")
    got = {(r.project, r.number): r.score for r in searcher.scored(rows).collect()}
    lengths = {k: len(v.replace(":", " ").split()) for k, v in LOGS.items()}
    average = sum(lengths.values()) / len(lengths)
    idf = math.log(1 + (5 - 3 + 0.5) / 3.5)
    for key, tf in ((("app", 1), 1), (("app", 2), 1), (("folder/job", 7), 3)):
        norm = 1.2 * (0.25 + 0.75 * lengths[key] / average)
        assert got[key] == round(idf * tf / (tf + norm), 4)


def test_plan_shuffles_only_for_the_top(spark, searcher):
    rows = spark.createDataFrame([(0, "build ok")], "qid bigint, q string")
    ranked = searcher.ranked(rows)
    ranked.collect()
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("Exchange hashpartitioning") == 1
    assert "dynamicpruning" in plan


def test_search_rows(spark, runs, searcher):
    rows = spark.createDataFrame([(0, "failed"), (1, "j:web")], "qid bigint, q string")
    found = {r.qid: r for r in searcher.search(rows, runs, "http://ci/").collect()}
    assert found[0].search_name == "app#2"
    assert found[0].url == "http://ci/job/app/2/"
    assert found[0].show_console
    assert found[0].fragments == ["build <B>failed</B>: disk full<br/>retry <B>failed</B>"]
    assert found[1].search_name == "web#3" and not found[1].show_console
    assert found[1].fragments is None


def test_visibility_after_and_before_paging(spark, runs, searcher):
    visible = spark.createDataFrame([("app",)], "project string")
    rows = spark.createDataFrame([(0, "build")], "qid bigint, q string")
    for first in (False, True):
        found = searcher.search(rows, runs, "http://ci/", visible=visible, filter_first=first)
        assert {r.search_name for r in found.collect()} == {"app#1", "app#2"}


def test_page_keeps_lower_ranked_of_equal_names(spark, searcher):
    docs = searcher.docs.withColumn("d", F.lit("#x"))
    rows = spark.createDataFrame([(0, "build")], "qid bigint, q string")
    found = Searcher(searcher.index, docs).pages(rows).collect()
    assert [(r.search_name, r.rank) for r in sorted(found, key=lambda r: r.pos_in_page)] == [
        ("folder/job#x", 1),
        ("app#x", 3),
    ]


def test_pages_are_disjoint_and_complete(spark):
    scored = spark.range(1050).select(
        (F.col("id") % 2).alias("qid"),
        F.lit("p").alias("project"),
        F.col("id").alias("number"),
        (F.col("id") % 3).cast("double").alias("score"),
    )
    paged = rank.with_page(rank.rank_all(scored, partitions=7))
    by_window = rank.top_hits(scored, 10**6)
    assert paged.select("qid", "number", "rank").exceptAll(by_window.select("qid", "number", "rank")).count() == 0
    sizes = {(r.qid, r.page): r["count"] for r in paged.groupBy("qid", "page").count().collect()}
    assert sizes == {(q, p): 100 if p < 6 else 25 for q in (0, 1) for p in range(1, 7)}


def test_keyset_pages_equal_rank_pages(spark):
    scored = spark.range(350).select(
        F.lit(0).cast("bigint").alias("qid"),
        F.concat(F.lit("p"), F.col("id") % 3).alias("project"),
        F.col("id").alias("number"),
        (F.col("id") % 5).cast("double").alias("score"),
    )
    ranked = {r.rank: r.number for r in rank.top_hits(scored, 350).collect()}
    last = rank.top_hits(scored).where("rank = 100")
    second = {r.rank: r.number for r in rank.next_page(scored, last).collect()}
    assert second == {i: ranked[100 + i] for i in range(1, 101)}


def test_phrase_needs_neighbours(spark, searcher):
    phrases = spark.createDataFrame(
        [(0, "disk full"), (1, "full disk"), (2, "build build"), (3, "full retry")],
        "qid bigint, phrase string",
    )
    for index in (None, searcher.index):
        found = predicates.phrase_match(searcher.docs, phrases, ["c"], index=index)
        assert {(r.qid, r.project, r.number) for r in found.collect()} == {
            (0, "app", 2), (2, "folder/job", 7), (3, "app", 2),
        }


def test_extension_is_searchable_but_not_stored(spark, runs):
    tests = spark.createDataFrame(
        [("app", 1, 2, "second", "boom"), ("app", 1, 1, "first", None)],
        "project string, number bigint, seq bigint, title string, error_details string",
    )
    registry = FieldRegistry()
    registry.register_text_field("unittest", E.failed_test_text(tests))

    def broken(_):
        raise RuntimeError("broken extension")

    registry.register_text_field("broken", broken, persist=True)
    docs = D.build_documents(runs, registry)
    text = {(r.project, r.number): r.unittest for r in docs.collect()}
    assert text[("app", 1)] == "first\nnull\nsecond\nboom\n" and text[("web", 3)] == ""
    stored = D.stored_documents(docs, registry)
    assert "unittest" not in stored.columns and "broken" in stored.columns
    index = SearchIndex.build(docs, scratch_path(spark, "t"), registry, doc_buckets=4)
    assert ask(spark, Searcher(index, stored), "boom", "unittest:first", "c:boom") == [
        {("app", 1)}, {("app", 1)}, set(),
    ]


@pytest.mark.parametrize("keyword", ["c", "Upper", "project", "with space", ""])
def test_bad_keywords_are_refused(keyword):
    with pytest.raises(ValueError):
        FieldRegistry().register_text_field(keyword, lambda runs: runs)


def test_guarded_text_turns_errors_into_null(spark):
    def half(value):
        return value.split(":")[1]

    rows = spark.createDataFrame([("a:b",), ("x",), (None,)], "v string")
    got = [r.t for r in rows.select(D.guarded_text(half)("v").alias("t")).collect()]
    assert got == ["b", None, None]


def test_every_field_is_indexed(spark, runs):
    registry = FieldRegistry()
    fields = P.postings(D.build_documents(runs), registry.all_keys, registry.exact_keys)
    assert {r.field for r in fields.select("field").distinct().collect()} == set(registry.all_keys)


def test_one_hot_run_and_word(spark):
    """A third of all tokens are one word, a third of all documents one job."""
    from pyspark.sql.types import StringType

    docs = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("j"), F.col("id"))).alias("project"),
        F.col("id").alias("number"),
        F.lit(None).cast(StringType()).alias("d"),
        F.when(F.col("id") % 3 == 0, F.repeat(F.lit("hot "), 20)).otherwise(
            F.concat(F.lit("cold w"), F.col("id"))
        ).alias("c"),
    ).withColumn("j", F.col("project")).withColumn("d", F.concat(F.lit("#"), F.col("number")))
    for limit in (0, 1 << 26):
        searcher = Searcher(
            SearchIndex.build(docs, scratch_path(spark, "t"), doc_buckets=4), docs, broadcast_limit=limit
        )
        rows = spark.createDataFrame([(0, "c:hot"), (1, "cold OR hot")], "qid bigint, q string")
        counts = {r.qid: r.n_hits for r in rank.page_counts(searcher.scored(rows)).collect()}
        assert counts == {0: 300, 1: 900}


def test_index_follows_changes(spark, runs):
    docs = D.build_documents(runs)
    first = SearchIndex.build(docs, scratch_path(spark, "t"), doc_buckets=4)
    gone = docs.where("project = 'web'")
    changed = docs.where("project = 'app' AND number = 1")
    new = changed.withColumn("c", F.lit("echo build disk"))
    second = first.update(gone.unionByName(changed), new, scratch_path(spark, "t"))
    added = spark.createDataFrame(
        [("fresh", 1, "fresh", "1", "#1", None, "echo once more")], docs.schema
    )
    third = second.update(docs.limit(0), added, scratch_path(spark, "t"))
    expected = docs.where("project != 'web' AND NOT (project = 'app' AND number = 1)")
    expected = expected.unionByName(new).unionByName(added)
    rebuilt = SearchIndex.build(expected, scratch_path(spark, "t"), doc_buckets=4)
    compacted = third.compact(scratch_path(spark, "t"))
    reopened = SearchIndex.open(spark, third.path)
    rows = spark.createDataFrame(
        list(enumerate([*CASES, "echo", "fresh echo", "web nothing", "disk"])), "qid bigint, q string"
    )

    def everything(index):
        found = Searcher(index, expected).scored(rows).collect()
        return sorted((r.qid, r.project, r.number, r.score) for r in found)

    assert everything(third) == everything(rebuilt)
    assert everything(compacted) == everything(rebuilt)
    assert everything(reopened) == everything(rebuilt)
    assert {r.project for r in third.jobs.collect()} == {"app", "app test", "folder/job", "fresh"}


def test_pieces_are_one_field(spark, runs):
    registry = FieldRegistry()
    registry.register_text_field("artifact", lambda runs: runs)
    pieces = spark.createDataFrame(
        [("app", 1, "artifact", "alpha beta"), ("app", 1, "artifact", "alpha gamma")],
        "project string, number bigint, field string, text string",
    )
    docs = D.build_documents(runs)
    index = SearchIndex.build(docs, scratch_path(spark, "t"), registry, doc_buckets=4, pieces=pieces)
    found = ask(spark, Searcher(index, docs), "beta gamma", "artifact:alpha", "c:alpha")
    assert found == [{("app", 1)}, {("app", 1)}, set()]
    row = index.postings.where("field = 'artifact' AND term = 'alpha'").first()
    assert (row.tf, row.dl) == (2, 4)


def test_few_words_reach_the_scan(spark, sf):
    """A search for few words filters the postings by them, beside the join that decides."""
    few = spark.createDataFrame([(1, "the")], "qid long, q string")
    from runsift.plans import registered as R

    plan = R.searcher(spark, sf).scored(few)._jdf.queryExecution().optimizedPlan().toString()
    assert "= the)" in plan
