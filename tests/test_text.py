from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runsift.functions import text as X
from runsift.operators import postings as P
from runsift.operators import predicates


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first().r


def test_tokenizer_vectors(spark):
    got = one(spark, "can't 3.14 a.b foo_bar folder/job #12 a:b wi-fi 日本 Echo echo", X.tokens)
    assert got == [
        "can't", "3.14", "a.b", "foo_bar", "folder", "job", "12", "a:b", "wi", "fi", "日本",
        "Echo", "echo",
    ]


def test_log_tokens(spark):
    """Some marks join letters, others digits; none joins a letter and a digit."""
    text = "build1.log Test2.java foo:bar 1,000 1;2 3.14 10:30 a,b a1.b2 x.y.z 1.2.3 a. .b can’t v1.2 _a._b"
    assert one(spark, text, X.tokens) == [
        "build1", "log", "Test2", "java", "foo:bar", "1,000", "1;2", "3.14", "10", "30", "a", "b", "a1", "b2",
        "x.y.z", "1.2.3", "a", "b", "can’t", "v1.2", "_a", "_b",
    ]


def test_large_texts_give_the_same_tokens(spark):
    """Only line-safe tokenizers see lines; others, and exact fields, see the whole text at any size."""
    schema = "project string, number bigint, field string, text string"

    def counted(n, tokenizer, exact=()):
        rows = spark.createDataFrame([("p", 1, "c", "a\nb," * n)], schema)
        found = P.token_rows(rows, exact, tokenizer).groupBy("term").count().collect()
        return {r.term: r["count"] for r in found}

    small, large = 1000, 300_000
    assert large * 4 > X.CHUNK_BYTES
    commas = X.pattern_tokenizer("[^,]+")
    assert counted(small, commas) == {"a\nb": small} and counted(large, commas) == {"a\nb": large}
    assert counted(large, X.tokens) == {"a": large, "b": large}
    assert len(counted(large, X.tokens, ("c",))) == 1


def test_long_tokens_are_cut(spark):
    got = one(spark, "x" * 600 + " y", X.tokens)
    assert [len(t) for t in got] == [255, 255, 90, 1]


def test_large_text_is_cut_into_chunks_without_loss(spark):
    text = ("line one of 3.14 words\n\n  - indented can't\n" * 40000) + "no newline at end"
    assert len(text) > X.CHUNK_BYTES
    rows = spark.createDataFrame([(text,)], "v string")
    row = rows.select(
        X.chunks(F.col("v")).alias("c"), X.tokens(F.col("v")).alias("whole")
    ).select(
        F.size("c").alias("n"),
        (F.array_join("c", "") == text).alias("same"),
        (F.flatten(F.transform("c", X.tokens)) == F.col("whole")).alias("tokens_same"),
        (F.flatten(F.transform("c", X.pieces)) == X.pieces(F.lit(text))).alias("pieces_same"),
    ).first()
    assert row.n > 40000 and row.same and row.tokens_same and row.pieces_same


def test_pieces_lose_nothing(spark):
    texts = ["", "a", "  a.b  can't!  ", "x" * 300 + "--" + "y" * 700, "日本 (3.14)\r\n", "_._"]

    @settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.text(max_size=80), min_size=200, max_size=200))
    def check(generated):
        values = texts + [g.replace("\x00", "") for g in generated]
        values = [v for v in values if v.encode("utf-8", "ignore").decode() == v]
        rows = spark.createDataFrame([(v,) for v in values], "v string")
        bad = rows.where(F.array_join(X.pieces(F.col("v")), "") != F.col("v"))
        assert bad.count() == 0

    check()


def test_parameter_text(spark):
    row = spark.sql(
        "SELECT array(named_struct('name','a','value','x'), named_struct('name','b','value',"
        "CAST(NULL AS STRING))) p, CAST(NULL AS array<struct<name:string,value:string>>) q"
    ).select(X.parameter_text(F.col("p")).alias("p"), X.parameter_text(F.col("q")).alias("q")).first()
    assert row.p == "x null " and row.q is None


def test_urls_and_labels(spark):
    row = spark.range(1).select(
        *[
            X.hit_url(F.lit(a), F.lit(b)).alias(f"u{i}")
            for i, (a, b) in enumerate(
                [("http://h", "x/"), ("http://h/", "x/"), ("http://h", "/x/"), ("http://h/", "/x/")]
            )
        ],
        X.job_label(F.lit("Folder"), F.lit("job"), "root").alias("inside"),
        X.job_label(F.lit("ROOT"), F.lit("job"), "root").alias("at_root"),
        X.count_label(F.lit(99), 100).alias("few"),
        X.count_label(F.lit(100), 100).alias("full"),
        X.html_line_ends(F.lit("a\r\nb\nc\rd")).alias("br"),
        X.expand_variables(
            F.lit("$JOB/${N}/$JOBS"), {"JOB": F.lit("j"), "N": F.lit("1")}
        ).alias("vars"),
    ).first()
    assert {row.u0, row.u1, row.u2, row.u3} == {"http://h/x/"}
    assert (row.inside, row.at_root, row.few, row.full) == ("Folder >> job", "job", "99", "100+")
    assert row.br == "a<br/>b<br/>c<br/>d"
    assert row.vars == "j/1/$JOBS"


def test_wildcard_regex(spark):
    cases = [
        ("lin*", "linux", True), ("*nux", "linux", True), ("l?nux", "linux", True),
        ("l?nux", "lnux", False), ("*", "x", True), ("a.c", "abc", False), ("a.c", "a.c", True),
        ("li*x*", "linux", True), ("*in*", "linux", True), ("lin", "linux", False),
    ]
    rows = spark.createDataFrame(cases, "pattern string, term string, fits boolean")
    vocabulary = rows.select(F.lit(0).alias("tp"), F.lit("c").alias("field"), "term", F.lit(1).alias("df")).distinct()
    patterns = rows.withColumn("qid", F.monotonically_increasing_id()).withColumn("field", F.lit("c"))
    found = predicates.wildcard_terms(vocabulary, patterns.select("qid", "field", "pattern"))
    got = {(r.qid, r.term) for r in found.collect()}
    for r in patterns.collect():
        assert ((r.qid, r.term) in got) == r.fits, r
