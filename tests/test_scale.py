"""Tasks grow with the data, and results do not depend on how the work is cut."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runsift import FieldRegistry, SearchIndex, Searcher
from runsift.operators import documents as D
from runsift.operators import postings as P
from runsift.operators import counting, highlight, predicates, queryterms, rank, scoring
from runsift.schemas import RUNS
from runsift.session import scratch_path
from runsift.sources import index_tables

WORDS = ["build", "disk", "failed", "ok", "retry"]


@pytest.fixture(scope="module")
def docs(spark):
    """Forty runs; number 7 stands in both projects."""
    rows = []
    for n in range(40):
        text = " ".join(w for i, w in enumerate(WORDS * 2) if (n + 1) * (i + 3) % 7 < 4)
        rows.append(("app" if n % 3 else "web", n, f"#{n}", [("branch", WORDS[n % 5])], text, f"job/{n}/"))
    rows.append(("app" if rows[7][0] == "web" else "web", 7, "#7", None, "disk ok disk", "job/7/"))
    return D.build_documents(spark.createDataFrame(rows, RUNS))


@pytest.fixture(scope="module")
def index(spark, docs):
    return SearchIndex.build(docs, scratch_path(spark, "scale"), doc_buckets=4)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokens_are_counted_where_documents_were_spread(docs):
    rows = P.postings(docs, ["j", "n", "d", "p", "c"], {"n"}, partitions=4)
    assert plan(rows).count("Exchange") == 1


def test_a_build_has_more_tasks_for_more_input(spark, docs, index, monkeypatch):
    path = scratch_path(spark, "docs")
    docs.write.parquet(path)
    stored = spark.read.parquet(path)
    monkeypatch.setattr(index_tables, "TASK_BYTES", index_tables.source_bytes(stored) // 10)
    assert index._postings_of(stored).rdd.getNumPartitions() == 12


QUERIES = [
    "build disk", "build OR retry", "disk NOT failed", "app ok", "web build OR disk", "c:ok j:app", "p:disk retry",
    "NOT ok", "zz:build OR ok", "build/disk ok", "7", "ok ok",
]


@pytest.mark.parametrize("steps", [1, 4, 1 << 20])
def test_hits_do_not_depend_on_slices_and_steps(spark, docs, index, monkeypatch, steps):
    asked = spark.createDataFrame([*enumerate(QUERIES), (0, "build disk"), (None, "ok")], "qid bigint, q string")
    # Null and repeated qids belong to a query table's rows; they are answered the same on both ways.
    plain = Searcher(index, docs, broadcast_limit=0).scored(asked)
    monkeypatch.setattr(scoring, "TASK_POSTINGS", 20)
    monkeypatch.setattr(scoring, "STEP_PAIRS", steps)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "3")
    try:
        sliced = Searcher(index, docs).scored(asked)
        assert sliced.rdd.getNumPartitions() > 8
        ours = sliced.collect()
    finally:
        spark.conf.set(limit, before)

    def rows(found):
        return sorted((-1 if r.qid is None else r.qid, r.project, r.number, round(r.score, 3)) for r in found)

    assert rows(ours) == rows(plain.collect())
    assert len(ours) > 100


def test_runs_without_a_number_or_project_are_scored(spark, docs, monkeypatch):
    odd = docs.limit(6).withColumn("number", F.when(F.col("number") % 2 == 0, F.col("number")))
    odd = odd.withColumn("project", F.when(F.col("j") == "app", F.col("project")))
    index = SearchIndex.build(odd, scratch_path(spark, "odd"), doc_buckets=4)
    asked = spark.createDataFrame([(1, "build OR disk OR ok")], "qid bigint, q string")
    plain = Searcher(index, odd, broadcast_limit=0).scored(asked)
    monkeypatch.setattr(scoring, "TASK_POSTINGS", 1)
    sliced = Searcher(index, odd).scored(asked)

    def rows(found):
        return sorted((str(r.project), str(r.number), round(r.score, 3)) for r in found.collect())

    assert rows(sliced) == rows(plain)


def test_words_that_no_document_has_give_no_hits(spark, docs, index):
    asked = spark.createDataFrame([(1, "nowhere"), (2, "\"")], "qid bigint, q string")
    assert Searcher(index, docs).scored(asked).count() == 0


def test_wildcards_do_not_depend_on_slices(spark, index, monkeypatch):
    rows = [(1, "c", "*i*"), (1, "c", "b*"), (1, "c", "b*"), (1, "p", "*i*"), (2, "c", "?k"), (3, "c", "*"), (4, "c", "x*")]
    asked = spark.createDataFrame(rows, "qid bigint, field string, pattern string")
    whole = {tuple(r) for r in predicates.wildcard_match(index, asked).collect()}
    monkeypatch.setattr(scoring, "TASK_POSTINGS", 20)
    monkeypatch.setattr(scoring, "STEP_PAIRS", 3)
    sliced = predicates.wildcard_match(index, asked)
    assert sliced.rdd.getNumPartitions() > 8
    assert {tuple(r) for r in sliced.collect()} == whole
    assert {r[0] for r in whole} == {1, 2, 3}
    monkeypatch.setattr(predicates, "fits_broadcast", lambda df: False)
    plain = {tuple(r) for r in predicates.wildcard_match(index, asked).collect()}
    assert {r[:3] for r in plain} == {r[:3] for r in whole}


def test_tokens_counted_run_by_run_are_those_counted_by_grouping(spark, monkeypatch):
    """Repeated and missing keys, texts that go on in the next batch, runs smaller than a document."""
    rows = [("app", n % 5, f"#{n}", None, " ".join(WORDS * (n + 1) * 7) + f" w{n}", "") for n in range(12)]
    odd = D.build_documents(spark.createDataFrame(rows, RUNS))
    odd = odd.withColumn("number", F.when(F.col("number") != 3, F.col("number")))
    odd = odd.withColumn("p", F.when(F.col("number") == 1, ""))
    keys, limit = ["j", "n", "d", "p", "c"], "spark.sql.execution.arrow.maxRecordsPerBatch"
    grouped = P.token_rows(P.field_text(odd, keys), {"n"}).groupBy(*P.POSTING)
    wanted = grouped.agg(F.count(F.lit(1)).alias("tf"), F.max("n_tokens").alias("dl"), P._places())
    wanted = sorted(map(str, wanted.collect()))
    monkeypatch.setattr(counting, "RUN_TOKENS", 30)
    before = spark.conf.get(limit)
    spark.conf.set(limit, "3")
    try:
        found = P.postings(odd, keys, {"n"}, partitions=4)
        # Tokens are not grouped by a sort of them all.
        assert "Aggregate" not in plan(found) and "MapInArrow" in plan(found)
        assert sorted(map(str, found.collect())) == wanted
        apart = P.postings(odd, keys, {"n"}, partitions=4, part=lambda term: F.pmod(F.xxhash64(term), F.lit(3)))
        assert sorted(map(str, apart.collect())) == wanted
        assert sorted(map(str, P.postings(odd, keys, {"n"}, places=False).collect())) == sorted(
            map(str, found.drop("pos").collect())
        )
    finally:
        spark.conf.set(limit, before)


def test_a_large_run_is_counted_words_by_words(monkeypatch):
    words = [f"w{i % 7}" for i in range(50)]
    lists = pa.table({
        "project": ["a", "a", "b"], "number": [1, 1, None], "field": ["c"] * 3, "n_tokens": [40, 40, 10],
        "base": [0, 20, 0], "found": [words[:20], words[20:40], words[40:]],
    })
    parts = [[int(w[1:]) % 3 for w in found] for found in lists["found"].to_pylist()]
    run = [counting._encoded(lists.slice(0, 2)), counting._encoded(lists.slice(2))]
    apart = lists.append_column("parts", pa.array(parts, pa.list_(pa.int32())))

    def rows():
        return sorted(str(r) for b in counting._counted_run(run, True) for r in b.to_pylist())

    whole = rows()
    by_part = [r for b in counting._counted_run([counting._encoded(apart)], True) for r in b.to_pylist()]
    assert sorted(map(str, by_part)) == whole
    order = [(int(r["term"][1:]) % 3, r["term"]) for r in by_part]
    assert order == sorted(order)
    monkeypatch.setattr(counting, "STEP_TOKENS", 9)
    assert rows() == whole
    assert len(whole) == 14


def test_a_patterns_terms_are_found_by_its_rarest_key(spark, index, monkeypatch):
    """Terms under the other keys are neither read again nor shuffled; repeated grams give a term once."""
    sizes = []
    offered = predicates._offered

    def counted(by_gram, wanted, small):
        sizes.append({(r.field, r.key) for r in wanted.select("field", "key").collect()})
        return offered(by_gram, wanted, small)

    monkeypatch.setattr(predicates, "_offered", counted)
    asked = spark.createDataFrame([(1, "c", "fail*"), (2, "c", "*i*"), (3, "c", "zz*")], "qid bigint, field string, pattern string")
    terms = index.term_stats.select("field", "term")
    fitting = predicates.fitting_terms(index.grams.unionByName(index.grams), terms, asked)
    # Terms are compared where the grams are read.
    assert "Exchange hashpartitioning" not in plan(fitting)
    assert {tuple(r) for r in fitting.collect()} == {
        (1, "c", "failed"), (2, "c", "build"), (2, "c", "disk"), (2, "c", "failed"),
    }
    # Keys of patterns with several are counted, then each pattern has one.
    assert len(sizes) == 2 and len(sizes[1]) == 3


def test_ranked_hits_are_not_shuffled_again(spark, monkeypatch):
    """Slices follow from the number of hits; repeated hits and queries over many slices keep all their ranks."""
    scored = spark.range(600).select(
        (F.col("id") % 7 % 2).alias("qid"),
        F.when(F.col("id") % 5 > 0, "p").alias("project"),
        (F.col("id") % 200).alias("number"),
        (F.col("id") % 3).cast("double").alias("score"),
    )
    monkeypatch.setattr(rank, "TASK_HITS", 50, raising=False)
    ranked = rank.rank_all(scored)
    assert "Exchange hashpartitioning" not in plan(ranked) and "Window" not in plan(ranked)
    assert ranked.rdd.getNumPartitions() > 1
    found = [(r.qid, -r.score, r.project is not None, r.project or "", r.number, r["rank"]) for r in ranked.collect()]
    wanted = []
    for q in (0, 1):
        own = sorted(f[:5] for f in found if f[0] == q)
        wanted += [(*row, n) for n, row in enumerate(own, 1)]
    assert len(found) == 600
    assert sorted(found) == sorted(wanted)


def test_all_pages_are_spread_once_and_by_their_hits(spark, docs, index, monkeypatch):
    """Both windows of a page share one shuffle, whose tasks follow from the number of hits."""
    same = docs.withColumn("d", F.concat(F.lit("#"), (F.col("number") % 3).cast("string")))
    asked = spark.createDataFrame([(n, f"{w} OR build") for n, w in enumerate(WORDS)], "qid bigint, q string")
    columns = ["qid", "page", "pos_in_page", "search_name", "rank"]
    monkeypatch.setattr(rank, "with_page", lambda ranked: ranked.withColumn("page", F.ceil(F.col("rank") / 10).cast("int")))
    whole = sorted(map(str, Searcher(index, same).pages(asked, None).select(*columns).collect()))
    assert len(whole) > 60
    monkeypatch.setattr(rank, "TASK_HITS", 20, raising=False)
    spread = Searcher(index, same).pages(asked, None)
    assert plan(spread).count("Exchange hashpartitioning(qid") == 1
    assert spread.rdd.getNumPartitions() > 5
    assert sorted(map(str, spread.select(*columns).collect())) == whole


def test_spread_postings_are_not_read_bucket_by_bucket(spark, docs, index, monkeypatch):
    """Top hits of more postings than the buckets hold: the scan's tasks follow from the files, also of an updated index."""
    asked = spark.createDataFrame([*enumerate(QUERIES)], "qid bigint, q string")
    changed = docs.where("number % 5 = 0")
    now = changed.withColumn("c", F.concat("c", F.lit(" retry")))
    updated = index.update(changed, now, scratch_path(spark, "scale-update"))
    columns = ["qid", "project", "number", "score", "rank"]
    whole = [sorted(map(str, Searcher(i, docs).ranked(asked).select(*columns).collect())) for i in (index, updated)]
    assert whole[0] and whole[0] != whole[1]
    monkeypatch.setattr(scoring, "TASK_POSTINGS", 1)
    spread = [Searcher(i, docs).ranked(asked).select(*columns) for i in (index, updated)]
    assert "Bucketed: true" not in plan(spread[0])
    assert [sorted(map(str, s.collect())) for s in spread] == whole


def test_long_queries_are_parsed_in_several_tasks(spark, index, monkeypatch):
    """Few rows of much text, repeated and null ones included, are spread by their bytes."""
    rows = [*enumerate(QUERIES), (0, "build disk"), (None, "ok"), (99, None)]
    asked = spark.createDataFrame(rows, "qid bigint, q string").coalesce(1)
    parsed = queryterms.analyse(asked, index.jobs, small=True)
    wanted = sorted(map(str, parsed.collect()))
    assert len(parsed.inputFiles()) == 1
    monkeypatch.setattr(queryterms, "TASK_QUERY_BYTES", 16, raising=False)
    spread = Searcher(index, asked).analyse(asked)
    assert len(spread.inputFiles()) > 1
    assert sorted(map(str, spread.collect())) == wanted


def test_consoles_are_cut_in_tasks_by_their_number(spark, docs, index, monkeypatch):
    asked = spark.createDataFrame([*enumerate(QUERIES)], "qid bigint, q string")
    whole = sorted(map(str, Searcher(index, docs).fragments(asked).collect()))
    assert len(whole) > 60
    tasks = []
    cut = highlight.fragment_table

    def counted(consoles, *n):
        tasks.append(cut(consoles, *n).rdd.getNumPartitions())
        return cut(consoles, *n)

    monkeypatch.setattr(highlight, "fragment_table", counted)
    monkeypatch.setattr(highlight, "TASK_CONSOLES", 2, raising=False)
    assert sorted(map(str, Searcher(index, docs).fragments(asked).collect())) == whole
    assert tasks[0] > 15


# -- updates ------------------------------------------------------------------------------------


def all_rows(index):
    parts = (index.postings.drop("tp"), index.term_stats.drop("tp"), index.field_stats)
    return [sorted(map(str, part.collect())) for part in parts]


@pytest.fixture(scope="module")
def outdated(docs):
    return docs.where("number % 3 != 0").withColumn("c", F.concat(F.lit("outdated "), "c"))


@pytest.fixture(scope="module")
def stale(spark, outdated):
    return SearchIndex.build(outdated, scratch_path(spark, "stale"), doc_buckets=4)


def test_an_update_is_counted_and_read_without_a_shuffle_of_postings(spark, docs, index, outdated, stale, monkeypatch):
    """What goes is not tokenised again, and very many removed keys are no broadcast."""
    tokenised, inner = [], SearchIndex._postings_of
    monkeypatch.setattr(SearchIndex, "_postings_of", lambda self, d, *a, **k: tokenised.append(d) or inner(self, d, *a, **k))
    monkeypatch.setattr(index_tables, "fits_broadcast", lambda df: False)
    updated = stale.update(outdated, docs, scratch_path(spark, "update"))
    assert len(tokenised) == 1
    below = plan(updated.posting_parts(bucketed=False)[0])
    assert "ShuffledHashJoin" in below and "Sort " not in below
    assert below.count("Exchange") == 1  # the keys'
    assert all_rows(updated) == all_rows(index)


def test_runs_without_a_key_are_counted_out_of_an_update(spark, docs):
    odd = docs.limit(6).withColumn("number", F.when(F.col("number") > 2, F.col("number")))
    built = SearchIndex.build(odd, scratch_path(spark, "odd"), doc_buckets=4)
    updated = built.update(odd, odd, scratch_path(spark, "update"))
    assert all_rows(updated)[1:] == all_rows(built)[1:]


def test_an_update_spreads_only_its_pieces(spark, docs, outdated, monkeypatch):
    registry = FieldRegistry()
    registry.register_text_field("unittest", lambda runs: runs, persist=True)
    stored, inner = [], SearchIndex._store_postings
    monkeypatch.setattr(SearchIndex, "_store_postings", lambda self, rows: stored.append(plan(rows)) or inner(self, rows))
    pieces = docs.where("number % 2 = 0").select("project", "number", F.lit("unittest").alias("field"), F.col("c").alias("text"))
    of_old = pieces.join(outdated.select("project", "number"), ["project", "number"], "left_semi")
    stale = SearchIndex.build(outdated, scratch_path(spark, "stale"), registry, doc_buckets=4, pieces=of_old)
    for given in (pieces, None):
        updated = stale.update(outdated, docs, scratch_path(spark, "update"), given)
        top = stored[-1].split("Union")
        assert len(top) > 1 and "Exchange" not in top[0]
    built = SearchIndex.build(docs, scratch_path(spark, "whole"), registry, doc_buckets=4, pieces=of_old)
    assert all_rows(updated) == all_rows(built)


def test_layers_that_are_merged_are_written_once(spark, docs, index, outdated, stale, monkeypatch):
    merged, inner = [], SearchIndex.merged
    monkeypatch.setattr(SearchIndex, "merged", lambda self, *a: merged.append(a[1:]) or inner(self, *a))
    now = stale
    for low, high in ((0, 16), (16, 22), (22, 40)):
        own = F.col("number").between(low, high - 1)
        now = now.update_levelled(outdated.where(own), docs.where(own), scratch_path(spark, "update"))
    assert merged == [(3,)] and now.n_layers() == 2
    assert all_rows(now) == all_rows(index)


def test_common_terms_of_wildcards_are_not_spread_by_term(spark, index, monkeypatch):
    rows = [(1, "c", "*i*"), (1, "c", "b*"), (1, "c", "b*"), (1, "p", "*i*"), (2, "c", "?k"), (3, "c", "*"), (4, "c", "*y")]
    asked = spark.createDataFrame(rows, "qid bigint, field string, pattern string")
    whole = {tuple(r) for r in predicates.wildcard_match(index, asked).collect()}
    monkeypatch.setattr(predicates, "BROADCAST_LIMIT_BYTES", 0)
    monkeypatch.setattr(predicates, "fits_broadcast", lambda df: True)
    monkeypatch.setattr(predicates, "_COMMON_PAIRS", 9)
    split, inner = [], predicates._common_and_rare_hits

    def hits(index, known, common, weight):
        split.append((known.count(), common.count()))
        return inner(index, known, common, weight)

    monkeypatch.setattr(predicates, "_common_and_rare_hits", hits)
    assert {tuple(r) for r in predicates.wildcard_match(index, asked).collect()} == whole
    assert len(split) == 1 and 0 < split[0][1] < split[0][0]
