"""Stored positions, the directory of pages and the grams of the vocabulary."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from runsift import FieldRegistry, SearchIndex
from runsift.functions import text as X
from runsift.operators import documents as D
from runsift.operators import predicates
from runsift.plans import registered
from runsift.schemas import KEY, RUNS
from runsift.session import scratch_path
from runsift.sources.index_tables import holding

TEXTS = {
    1: "the red fox and the red hen and the red fox",
    2: "red the fox red",
    3: "a red the red fox",
    4: "fox",
    5: "",
}
PHRASES = ["the red", "red fox and the", "the red the red fox", "fox", "red red", "fox the", "nowhere red", "red hen and"]


def docs_of(spark, texts):
    rows = [("job", n, f"#{n}", None, text, f"job/{n}/") for n, text in texts.items()]
    return D.build_documents(spark.createDataFrame(rows, RUNS))


def phrases_of(spark, phrases):
    return spark.createDataFrame(list(enumerate(phrases)), "qid bigint, phrase string")


def plain_matches(texts, phrases):
    def words(text):
        return re.findall(r"\w+", text)

    def begins(text, phrase):
        have, want = words(text), words(phrase)
        return any(have[i : i + len(want)] == want for i in range(len(have) - len(want) + 1))

    return {(q, n) for q, p in enumerate(phrases) for n, t in texts.items() if begins(t, p)}


def found(index, docs, phrases):
    return {(r.qid, r.number) for r in predicates.phrase_match(docs, phrases, ["c", "d"], index=index).collect()}


@pytest.fixture(scope="module")
def index(spark):
    return SearchIndex.build(docs_of(spark, TEXTS), scratch_path(spark, "t"), doc_buckets=4)


def test_positions_stand_beside_counts(spark, index):
    got = {(r.number, r.term): r for r in index.postings.where("field = 'c'").collect()}
    for number, text in TEXTS.items():
        places = defaultdict(list)
        for i, word in enumerate(text.split()):
            places[word].append(i)
        for word, where in places.items():
            row = got.pop((number, word))
            assert (row.pos, row.tf, row.dl) == (where, len(where), len(text.split()))
    assert not got


@pytest.mark.parametrize("limit", [None, 0])
def test_phrases_by_positions(spark, index, monkeypatch, limit):
    """With and without broadcasts the index says what tokenising the documents says."""
    if limit is not None:
        monkeypatch.setattr(predicates, "BROADCAST_LIMIT_BYTES", limit)
    docs, phrases = docs_of(spark, TEXTS), phrases_of(spark, PHRASES)
    want = plain_matches(TEXTS, PHRASES)
    assert found(index, docs, phrases) == want
    assert {(r.qid, r.number) for r in predicates.phrase_match(docs, phrases, ["c"]).collect()} == want


def test_phrases_follow_updates(spark, index):
    """Positions of changed documents replace the old ones, through two layers and in one again."""
    old, now = docs_of(spark, {1: TEXTS[1], 4: TEXTS[4]}), docs_of(spark, {1: "hen fox red fox", 6: "the red hen"})
    first = index.update(old, now, scratch_path(spark, "t"))
    second = first.update(docs_of(spark, {6: "the red hen"}), docs_of(spark, {6: "red hen and"}), scratch_path(spark, "t"))
    texts = {n: t for n, t in TEXTS.items() if n not in (1, 4)} | {1: "hen fox red fox", 6: "red hen and"}
    want = plain_matches(texts, PHRASES)
    phrases = phrases_of(spark, PHRASES)
    assert found(second, old, phrases) == want
    assert found(second.compact(scratch_path(spark, "t")), old, phrases) == want
    assert found(SearchIndex.open(spark, second.path), old, phrases) == want


def test_phrase_over_chunk_ends(spark):
    """A text over the chunk size has its positions counted through, also over the ends of its chunks."""
    lines = [f"line {i} ends here" for i in range(80_000)]
    text = "\n".join(lines)
    assert len(text) > X.CHUNK_BYTES
    cut = [c[-20:] for c in spark.createDataFrame([(text,)], "v string").select(X.blocks(F.col("v"))).first()[0]]
    assert len(cut) > 5
    numbers = [int(re.search(r"line (\d+) ends here\n", c)[1]) for c in cut[:3]]
    phrases = [f"line {i} ends here line {i + 1}" for i in numbers] + ["here line 79999 ends here", "here here"]
    docs = docs_of(spark, {1: text, 2: "line 5 ends here"})
    index = SearchIndex.build(docs, scratch_path(spark, "t"), doc_buckets=4)
    assert found(index, docs, phrases_of(spark, phrases)) == {(q, 1) for q in range(4)}


def test_phrases_in_pieces(spark):
    """A phrase is found within a piece and never over the end of one."""
    registry = FieldRegistry()
    registry.register_text_field("artifact", lambda runs: runs)
    pieces = spark.createDataFrame(
        [("job", 1, "artifact", "alpha beta"), ("job", 1, "artifact", "gamma alpha"), ("job", 4, "artifact", "beta gamma")],
        "project string, number bigint, field string, text string",
    )
    docs = docs_of(spark, TEXTS)
    index = SearchIndex.build(docs, scratch_path(spark, "t"), registry, doc_buckets=4, pieces=pieces)
    phrases = phrases_of(spark, ["alpha beta", "beta gamma", "gamma alpha", "beta alpha", "alpha gamma"])
    rows = predicates.phrase_match(docs, phrases, ["artifact"], index=index).collect()
    assert {(r.qid, r.number) for r in rows} == {(0, 1), (1, 4), (2, 1)}


def test_phrases_read_no_document(spark, sf):
    files = registered.phrase_match(spark, sf).inputFiles()
    assert files and not any("documents.parquet" in f for f in files)


# -- directory of pages ------------------------------------------------------------------------


def scanned_rows(df):
    """Rows that the scans of a plan gave, after it ran."""
    counted = df.agg(F.count(F.lit(1)))
    counted.collect()

    def scans(node):
        if node.nodeName().startswith("Scan"):
            return [node]
        inner = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else []
        if "QueryStage" in node.nodeName():
            inner.append(node.plan())
        children = node.children()
        inner += [children.apply(i) for i in range(children.size())]
        return [s for n in inner for s in scans(n)]

    plan = counted._jdf.queryExecution().executedPlan()
    return sum(s.metrics().apply("numOutputRows").value() for s in scans(plan))


def test_listed_words_read_few_pages(spark):
    """Many words, far more than Parquet compares by default, and still only their pages are read."""
    words = F.transform(F.sequence(F.lit(0), F.lit(39_999)), lambda i: F.concat(F.lit("w"), F.lpad(i.cast("string"), 6, "0")))
    docs = spark.range(8).select(
        F.lit("job").alias("project"),
        F.col("id").alias("number"),
        *[F.lit(None).cast("string").alias(k) for k in ("j", "n", "d", "p")],
        F.array_join(words, " ").alias("c"),
    )
    index = SearchIndex.build(docs, scratch_path(spark, "t"), doc_buckets=4, term_parts=1)
    rows = index.postings.select(*KEY, "term", "tf")
    assert rows.count() == 320_000
    listed = [f"w{i:06d}" for i in [*range(100), *range(20_000, 20_100)]]
    few = holding(rows, "term", listed)
    assert few.count() == 8 * len(listed)
    assert scanned_rows(few) < 100_000
    assert scanned_rows(holding(index.grams, "gram", ["039"])) < index.grams.count() / 4


# -- vocabulary by grams -----------------------------------------------------------------------

WORDS = {1: "alpha beta alphabet a ab", 2: "gamma alphorn b Étage ét", 3: "tab cab abacus été"}
PATTERNS = ["al*", "*a", "*ph*", "a?", "?b", "*", "a*b", "???", "al*t", "*b*", "é*", "zz*", "ab", "*abe*", "?", "alpha*"]


def plain_wildcards(texts):
    out = set()
    for q, pattern in enumerate(PATTERNS):
        regex = "".join(".*" if ch == "*" else "." if ch == "?" else re.escape(ch) for ch in pattern)
        out |= {(q, n) for n, t in texts.items() for w in t.split() if re.fullmatch(regex, w)}
    return out


def wildcard_hits(spark, index):
    rows = [(q, "c", p) for q, p in enumerate(PATTERNS)]
    # The same patterns again, as other queries.
    rows += [(q + 100, "c", p) for q, p in enumerate(PATTERNS)]
    patterns = spark.createDataFrame(rows, "qid bigint, field string, pattern string")
    got = {(r.qid, r.number): r.score for r in predicates.wildcard_match(index, patterns).collect()}
    assert all(got[(q + 100, n)] == score for (q, n), score in got.items() if q < 100)
    return {key for key in got if key[0] < 100}


@pytest.mark.parametrize("limit", [None, 0])
def test_wildcards_by_grams(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(predicates, "BROADCAST_LIMIT_BYTES", limit)
    index = SearchIndex.build(docs_of(spark, WORDS), scratch_path(spark, "t"), doc_buckets=4)
    assert wildcard_hits(spark, index) == plain_wildcards(WORDS)


def test_several_patterns_of_one_query(spark):
    """They add up; a pattern that fits nothing adds nothing."""
    index = SearchIndex.build(docs_of(spark, WORDS), scratch_path(spark, "t"), doc_buckets=4)
    rows = [(1, "c", "*cus"), (1, "c", "zz*"), (1, "d", "*"), (2, "c", "*cus"), (3, "d", "*"), (1, "c", "gam*")]
    patterns = spark.createDataFrame(rows, "qid bigint, field string, pattern string")
    got = {(r.qid, r.number): r.score for r in predicates.wildcard_match(index, patterns).collect()}
    assert set(got) == {(1, 1), (1, 2), (1, 3), (2, 3), (3, 1), (3, 2), (3, 3)}
    assert got[1, 3] == pytest.approx(got[2, 3] + got[3, 3], abs=2e-4)


def test_wildcards_follow_updates(spark):
    index = SearchIndex.build(docs_of(spark, WORDS), scratch_path(spark, "t"), doc_buckets=4)
    new = {1: "alpha delta", 4: "alphonse abba"}
    updated = index.update(docs_of(spark, {1: WORDS[1]}), docs_of(spark, new), scratch_path(spark, "t"))
    want = plain_wildcards({n: t for n, t in WORDS.items() if n != 1} | new)
    assert wildcard_hits(spark, updated) == want
    assert wildcard_hits(spark, updated.compact(scratch_path(spark, "t"))) == want


# -- layers ------------------------------------------------------------------------------------


def test_many_updates_leave_few_layers(spark):
    """Nine updates, one document each: layers of like size are merged, and nothing is lost or doubled."""
    texts = {n: f"first text of run {n}" for n in range(1, 13)}
    index = SearchIndex.build(docs_of(spark, texts), scratch_path(spark, "t"), doc_buckets=2, term_parts=1)
    for step in range(9):
        number = step % 6 + 1
        new = {number: f"red fox {step} again", 20 + step: f"new run of step {step}"}
        before = {n: texts[n] for n in new if n in texts}
        index = index.update_levelled(docs_of(spark, before), docs_of(spark, new), scratch_path(spark, "t"))
        texts |= new
        assert index.n_layers() <= 2 + (step + 1).bit_length()
    rebuilt = SearchIndex.build(docs_of(spark, texts), scratch_path(spark, "t"), doc_buckets=2, term_parts=1)
    columns = ["project", "number", "field", "term", "tf", "dl", "pos"]

    def rows(df):
        return sorted(map(str, df.collect()))

    assert rows(index.postings.select(columns)) == rows(rebuilt.postings.select(columns))
    assert rows(index.term_stats) == rows(rebuilt.term_stats)
    assert rows(index.field_stats) == rows(rebuilt.field_stats)
    phrases = ["red fox", "first text of", "of step 8", "fox 2 again"]
    assert found(index, None, phrases_of(spark, phrases)) == plain_matches(texts, phrases)
