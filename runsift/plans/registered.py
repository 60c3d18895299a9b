"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runsift.fields import FieldRegistry
from runsift.functions import text as X
from runsift.operators import documents as D
from runsift.operators import extensions as E
from runsift.operators import highlight as H
from runsift.operators import maintain as M
from runsift.operators import postings as P
from runsift.operators import predicates
from runsift.operators import queryterms as Q
from runsift.operators import rank as R
from runsift.operators import results
from runsift.plans.search import Searcher
from runsift.schemas import KEY, WORD_CHARS
from runsift.session import scratch_path, written
from runsift.sources import adapters as A
from runsift.sources.document_table import read_documents, write_documents, write_hits
from runsift.sources.index_tables import SearchIndex
from runsift.sources.logs import path_selected
from runsift.streaming.changes import ChangeLog, compacted, event_stream, job_deletions, latest_state

Query = Callable[[SparkSession, str], DataFrame]

FIELDS = ["j", "n", "d", "p", "c"]
EXACT = {"n"}
ROOT_URL = "http://ci.example/"

# One index per session and data folder: searches share it as a running service would.
_indexes: dict[tuple[str, str], SearchIndex] = {}


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return D.build_documents(A.runs(spark, sf))


def index(spark: SparkSession, sf: str) -> SearchIndex:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _indexes:
        _indexes[key] = SearchIndex.build(documents(spark, sf), scratch_path(spark, "index"))
    return _indexes[key]


def searcher(spark: SparkSession, sf: str) -> Searcher:
    return Searcher(index(spark, sf), documents(spark, sf))


def _matches(*shapes: str) -> Query:
    """All matching documents of queries with the given shapes."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        return searcher(spark, sf).scored(A.queries(spark, sf, shapes)).select("qid", *KEY)

    return query


def _digest(column: str):
    return F.md5(F.col(column).cast("binary"))


# -- documents and postings -----------------------------------------------------------------


def extract_fields(spark, sf):
    return documents(spark, sf).select(*KEY, "j", "n", "d", "p", _digest("c").alias("c_md5"))


def parameter_text(spark, sf):
    def pair(name, value):
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    rows = A.table(spark, sf, "documents").select(
        F.col("doc_id").alias("number"),
        F.when(
            F.col("doc_id") % 5 != 0,
            F.array(
                pair("lang", F.col("lang")),
                pair("none", F.lit(None)),
                pair("size", F.col("n_chars")),
            ),
        ).alias("parameters"),
    )
    return rows.select("number", X.parameter_text(F.col("parameters")).alias("p"))


def _token_digest(tokens_of):
    def query(spark, sf):
        rows = A.table(spark, sf, "documents").select("doc_id", tokens_of(F.col("text")).alias("t"))
        return rows.select(
            "doc_id",
            F.size("t").cast("bigint").alias("n_tokens"),
            F.size(F.array_distinct("t")).cast("bigint").alias("n_distinct"),
            F.coalesce(F.array_max(F.transform("t", F.length)), F.lit(0)).cast("bigint").alias("longest"),
            F.md5(F.array_join("t", "|").cast("binary")).alias("tokens_md5"),
        )

    return query


tokenize = _token_digest(X.tokens)
tokenize_custom = _token_digest(X.pattern_tokenizer(r"[^\s,.]+"))


def tokenize_max_len(spark, sf):
    """Each text without its gaps is one token, cut into pieces of at most 255 characters."""
    squeeze = _token_digest(lambda text: X.tokens(F.regexp_replace(text, rf"[^{WORD_CHARS}]+", "")))
    return squeeze(spark, sf)


def stopword_filter(spark, sf):
    stop = A.table(spark, sf, "benchmark").select(F.explode(X.tokens(F.col("text"))).alias("term"))
    rows = P.token_rows(P.field_text(documents(spark, sf), ["c"]))
    return (
        P.without_stop_words(rows, stop)
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("n_left"), F.count_distinct("term").alias("n_distinct"))
    )


def postings(spark, sf):
    """Postings, folded to one row per document and field."""
    rows = P.postings(documents(spark, sf), FIELDS, EXACT)
    return rows.groupBy(*KEY, "field").agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.sum("tf").alias("n_tokens"),
        F.max("dl").alias("dl"),
        F.sum(F.col("tf") * F.col("tf")).alias("sum_sq"),
        F.min("term").alias("first_term"),
        F.max("term").alias("last_term"),
    )


def positions(spark, sf):
    rows = P.positions(documents(spark, sf), ["j", "d", "p", "c"])
    return rows.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("pos").alias("sum_pos"),
        F.max("pos").cast("bigint").alias("max_pos"),
    )


def term_stats(spark, sf):
    return index(spark, sf).term_stats.select("field", "term", "df")


def field_stats(spark, sf):
    return index(spark, sf).field_stats.select(
        "field", "n_docs", F.round("avg_len", 6).alias("avg_len")
    )


def doc_lengths(spark, sf):
    return P.doc_lengths(index(spark, sf).postings)


def _updated_index(spark, sf):
    """An index that was built on the outdated documents and then brought up to date."""
    old, now = _old_documents(spark, sf), documents(spark, sf)
    stale = SearchIndex.build(old, scratch_path(spark, "stale"))
    return stale.update(old, now, scratch_path(spark, "update"))


def index_update(spark, sf):
    """Searches on an updated index see the new documents and their statistics."""
    return Searcher(_updated_index(spark, sf), documents(spark, sf)).ranked(
        A.queries(spark, sf, RANKED)
    ).select("qid", *KEY, "score", F.col("rank").cast("bigint").alias("rank"))


def index_many_updates(spark, sf):
    """An outdated index brought up to date in four steps, its layers merged by size."""
    old, now = _old_documents(spark, sf), documents(spark, sf)
    current = SearchIndex.build(old, scratch_path(spark, "stale"))
    for step in range(4):
        own = F.col("number") % 4 == step
        current = current.update_levelled(old.where(own), now.where(own), scratch_path(spark, "update"))
    return Searcher(current, now).ranked(A.queries(spark, sf, RANKED)).select(
        "qid", *KEY, "score", F.col("rank").cast("bigint").alias("rank")
    )


def _unittest_registry() -> FieldRegistry:
    registry = FieldRegistry()
    registry.register_text_field("unittest", lambda runs: runs, persist=True)
    return registry


def update_with_stop_words(spark, sf):
    """An index with stop words, built on outdated documents and updated: its statistics leave them out."""
    stop = A.table(spark, sf, "benchmark").select(F.explode(X.tokens(F.col("text"))).alias("term"))
    old, now = _old_documents(spark, sf), documents(spark, sf)
    stale = SearchIndex.build(old, scratch_path(spark, "stale"), stop_words=stop)
    return stale.update(old, now, scratch_path(spark, "update")).term_stats.select("field", "term", "df")


def _test_pieces(spark, sf, text):
    tests = A.failed_tests(spark, sf)
    return tests.select(*KEY, F.lit("unittest").alias("field"), text.alias("text"))


def _whole_test():
    return F.concat(F.col("title"), F.lit("\n"), F.col("error_details"))


def _piece_terms(index):
    found = index.postings.where("field = 'unittest'").groupBy("field", "term")
    counted = found.agg(F.count(F.lit(1)).alias("n_postings"), F.sum("tf").alias("n_tokens"))
    return counted.join(index.term_stats.drop("tp"), ["field", "term"])


def update_with_pieces(spark, sf):
    """Text that comes in many rows, changed and new, takes the place of what its runs had."""
    old, now = _old_documents(spark, sf), documents(spark, sf)
    stale_text = _test_pieces(spark, sf, F.concat(F.lit("stale "), F.col("title")))
    stale_text = stale_text.join(old.select(*KEY), KEY, "left_semi")
    stale = SearchIndex.build(old, scratch_path(spark, "stale"), _unittest_registry(), pieces=stale_text)
    pieces = _test_pieces(spark, sf, _whole_test())
    return _piece_terms(stale.update(old, now, scratch_path(spark, "update"), pieces))


def update_keeps_pieces(spark, sf):
    """Text that comes in many rows stays with its runs when their documents are replaced."""
    old, now = _old_documents(spark, sf), documents(spark, sf)
    pieces = _test_pieces(spark, sf, _whole_test()).join(old.select(*KEY), KEY, "left_semi")
    stale = SearchIndex.build(old, scratch_path(spark, "stale"), _unittest_registry(), pieces=pieces)
    return _piece_terms(stale.update(old, now, scratch_path(spark, "update")))


def index_pieces(spark, sf):
    """Extension text indexed from its pieces, without joining them into one string first."""
    def piece(rows, field, first, second):
        text = F.concat(F.col(first), F.lit("\n"), F.col(second))
        return rows.select(*KEY, F.lit(field).alias("field"), text.alias("text"))

    tests = piece(A.failed_tests(spark, sf), "unittest", "title", "error_details")
    files = piece(A.artifacts(spark, sf), "artifact", "path", "content")
    return P.piece_postings(tests.unionByName(files)).groupBy(*KEY, "field").agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.sum("tf").alias("n_tokens"),
        F.max("dl").alias("dl"),
    )


# -- query tables -----------------------------------------------------------------------------


def query_pieces(spark, sf):
    rows = A.queries(spark, sf).select("qid", F.posexplode(X.query_pieces(F.col("q"))).alias("i", "p"))
    return rows.select(
        "qid", F.col("i").cast("bigint").alias("i"), F.col("p.field").alias("field"),
        F.col("p.text").alias("text"),
    )


def query_escape(spark, sf):
    return A.queries(spark, sf).select("qid", X.escaped_query(F.col("q")).alias("escaped"))


def _analysed(spark, sf):
    return searcher(spark, sf).analyse(A.queries(spark, sf))


def query_occur(spark, sf):
    """The clauses of every query as parsed, without regard to job mode."""
    rows = Q.analyse(A.queries(spark, sf))
    return rows.where("valid").select("qid", F.explode("clauses").alias("c")).select(
        "qid",
        F.col("c.clause_no").cast("bigint").alias("clause_no"),
        F.col("c.occur").alias("occur"),
        F.coalesce("c.field", F.lit("")).alias("field"),
        F.array_join("c.terms", " ").alias("terms"),
    )


def query_validity(spark, sf):
    return Q.analyse(A.queries(spark, sf)).select("qid", "valid")


def query_job_mode(spark, sf):
    return _analysed(spark, sf).select(
        "qid", "job_mode", F.coalesce(F.array_join("job_terms", " "), F.lit("")).alias("job_terms")
    )


def query_show_console(spark, sf):
    return _analysed(spark, sf).select("qid", "show_console")


# -- ranking, pages, results --------------------------------------------------------------------

# Frequent words, so that results run over many pages.
PAGED = ("{w3} OR {w4} OR {w5}",)
RANKED = ("{w3} {w4} {w5}", "{w3} OR {w4}", "src1 {w3}")


def bm25_topk(spark, sf):
    return searcher(spark, sf).ranked(A.queries(spark, sf, RANKED)).select(
        "qid", *KEY, "score", F.col("rank").cast("bigint").alias("rank")
    )


def first_hit(spark, sf):
    return R.first_hit(searcher(spark, sf).scored(A.queries(spark, sf, RANKED)))


def page_2_keyset(spark, sf):
    """The second page, continued from the last hit of the first."""
    scored = searcher(spark, sf).scored(A.queries(spark, sf, PAGED))
    last = written(R.top_hits(scored).where("rank = 100"), "cursors")
    return R.next_page(scored, last).select(
        "qid", *KEY, "score", F.col("rank").cast("bigint").alias("rank")
    )


def rank_every_hit(spark, sf):
    """Ranks and pages of all hits, whatever their number."""
    ranked = R.rank_all(searcher(spark, sf).scored(A.queries(spark, sf, PAGED)))
    return R.with_page(ranked).select(
        "qid", *KEY, "rank", F.col("page").cast("bigint").alias("page")
    )


def page_navigation(spark, sf):
    counts = R.page_counts(searcher(spark, sf).scored(A.queries(spark, sf, PAGED)))
    return counts.select("qid", "n_hits", F.col("last_page").cast("bigint").alias("last_page"))


def _repeated_names(spark, sf):
    """Documents whose display names repeat, so that pages hold equal names."""
    return documents(spark, sf).withColumn(
        "d", F.concat(F.lit("#"), (F.col("number") % 7).cast("string"))
    )


def page_dedupe(spark, sf):
    found = Searcher(index(spark, sf), _repeated_names(spark, sf)).pages(A.queries(spark, sf, PAGED), None)
    return found.select(
        "qid", F.col("page").cast("bigint").alias("page"), "search_name", *KEY,
        F.col("rank").cast("bigint").alias("rank"),
    )


def page_order(spark, sf):
    return searcher(spark, sf).pages(A.queries(spark, sf, PAGED), None).select(
        "qid", F.col("page").cast("bigint").alias("page"),
        F.col("pos_in_page").cast("bigint").alias("pos_in_page"), "search_name",
    )


def page_labels(spark, sf):
    paged = R.with_page(R.rank_all(searcher(spark, sf).scored(A.queries(spark, sf, PAGED))))
    return results.page_sizes(paged).select(
        "qid", F.col("page").cast("bigint").alias("page"), "n_hits", "label"
    )


def _name_queries(spark, sf):
    """Queries that are also job names or beginnings of them."""
    return A.queries(spark, sf, ("{w3} {w4}", "src1", "src")).unionByName(
        A.jobs(spark, sf).select(F.xxhash64("full_name").alias("qid"), F.col("name").alias("q"))
    )


def name_and_text_union(spark, sf):
    queries = _name_queries(spark, sf)
    names = results.name_hits(queries, A.jobs(spark, sf))
    pages = searcher(spark, sf).pages(queries).select("qid", "search_name", *KEY)
    both = results.names_then_text(names, pages.withColumn("show_console", F.lit(True)))
    return both.groupBy("search_name", "src", "show_console").agg(F.count(F.lit(1)).alias("n"))


def suggestions(spark, sf):
    queries = A.queries(spark, sf, ("{w3} {w4}", "src1", "src", "idle"))
    names = results.name_suggestions(queries, A.jobs(spark, sf))
    return results.suggestions(names, searcher(spark, sf).pages(queries))


def hit_url(spark, sf):
    """Root and run URL, each with and without the slash where they meet."""
    runs = A.runs(spark, sf)
    rel = F.when(F.col("number") % 2 == 0, F.concat(F.lit("/"), "url")).otherwise(F.col("url"))
    root = F.when(F.col("number") % 3 == 0, F.lit("http://ci.example")).otherwise(F.lit(ROOT_URL))
    return runs.select(*KEY, X.hit_url(root, rel).alias("url"))


def orphan_docs(spark, sf):
    """Documents of runs that are gone: the runs with a toxic label were removed."""
    labels = A.table(spark, sf, "labels").where("toxic = 1")
    runs = A.runs(spark, sf).join(labels, F.col("number") == F.col("doc_id"), "left_anti")
    return results.orphan_documents(documents(spark, sf), runs)


def visible_hits(spark, sf):
    ranked = searcher(spark, sf).ranked(A.queries(spark, sf, RANKED))
    kept = results.visible_hits(ranked, A.visible_projects(spark, sf))
    return kept.select("qid", *KEY, F.col("rank").cast("bigint").alias("rank"))


def visible_first(spark, sf):
    """Hidden projects dropped before ranking."""
    scored = searcher(spark, sf).scored(A.queries(spark, sf, RANKED))
    kept = R.top_hits(results.visible_hits(scored, A.visible_projects(spark, sf)))
    return kept.select("qid", *KEY, F.col("rank").cast("bigint").alias("rank"))


FRAGMENT_SHAPES = ("{w3} {w4} {w5}", "{w3} NOT {w4}", "p:fr {w3}")


def _fragments(spark, sf):
    return searcher(spark, sf).fragments(A.queries(spark, sf, FRAGMENT_SHAPES))


def search_stored_parts(spark, sf):
    """The whole search over documents stored in parts: only parts that hold hits are read."""
    path = scratch_path(spark, "documents")
    write_documents(documents(spark, sf), path, 8)
    stored = Searcher(index(spark, sf), read_documents(spark, path), doc_parts=8)
    return _shown(stored.search(
        A.queries(spark, sf, RANKED), A.runs(spark, sf), ROOT_URL, 1, A.visible_projects(spark, sf)
    ))


def hits_round_trip(spark, sf):
    """Ranked hits written for a front end and read back."""
    path = scratch_path(spark, "hits")
    write_hits(bm25_topk(spark, sf), path)
    return spark.read.parquet(path)


def fragments(spark, sf):
    return _fragments(spark, sf).select("qid", *KEY, F.array_join("fragments", " ... ").alias("fragments"))


def fragments_br(spark, sf):
    shown = H.display_fragments(F.col("fragments"))
    return _fragments(spark, sf).select(
        "qid", *KEY,
        F.size("fragments").cast("bigint").alias("n_fragments"),
        F.md5(F.array_join(shown, "|").cast("binary")).alias("shown_md5"),
    )


def search_pages(spark, sf):
    """The whole search, names to console fragments, hidden projects dropped."""
    found = searcher(spark, sf).search(
        A.queries(spark, sf, RANKED), A.runs(spark, sf), ROOT_URL, 1, A.visible_projects(spark, sf)
    )
    return _shown(found)


def _shown(found):
    return found.select(
        "qid",
        F.col("page").cast("bigint").alias("page"),
        F.col("pos_in_page").cast("bigint").alias("pos_in_page"),
        "search_name",
        "url",
        "score",
        "show_console",
        F.coalesce(F.size("fragments"), F.lit(0)).cast("bigint").alias("n_fragments"),
    )


# -- maintenance ------------------------------------------------------------------------------


def _old_documents(spark, sf):
    """A document table that is behind: runs divisible by 3 missing, an outdated parameter field."""
    return documents(spark, sf).where("number % 3 != 0").withColumn("p", F.lit("old "))


def _state(docs):
    return docs.select(*KEY, "p", _digest("c").alias("c_md5"))


def rebuild_overwrite(spark, sf):
    return _state(M.rebuild_overwrite(_old_documents(spark, sf), A.runs(spark, sf), A.jobs(spark, sf)))


def rebuild_preserve(spark, sf):
    return _state(M.rebuild_preserve(_old_documents(spark, sf), A.runs(spark, sf), A.jobs(spark, sf)))


def _request(spark, sf):
    """Requested job names: those of visible projects, typed as one line, and one unknown name."""
    line = A.visible_projects(spark, sf).agg(
        F.concat(F.array_join(F.array_sort(F.collect_set("project")), "  "), F.lit(" nosuchjob")).alias("t")
    )
    return line.select(F.explode(M.requested_names(F.col("t"))).alias("name"))


def rebuild_subset(spark, sf):
    jobs = M.jobs_named(A.jobs(spark, sf), _request(spark, sf))
    return _state(M.rebuild_overwrite(_old_documents(spark, sf), A.runs(spark, sf), jobs))


def validate_jobs(spark, sf):
    return M.unknown_names(_request(spark, sf), A.jobs(spark, sf))


def empty_jobs(spark, sf):
    return M.empty_jobs(A.jobs(spark, sf), A.runs(spark, sf)).select("full_name", "name", "parent_name")


def job_labels(spark, sf):
    label = X.job_label(F.col("parent_name"), F.col("name"), "root")
    return A.jobs(spark, sf).select("full_name", label.alias("label"))


def _labelled(spark, sf):
    return A.table(spark, sf, "labels").join(
        A.table(spark, sf, "documents").select("doc_id", F.col("source").alias("project")), "doc_id"
    ).withColumnRenamed("doc_id", "number")


def remove_run(spark, sf):
    gone = _labelled(spark, sf).where("toxic = 1")
    return _state(M.remove_runs(documents(spark, sf), gone))


def upsert_run(spark, sf):
    changed = _labelled(spark, sf).where("quality = 1").select(*KEY)
    new = M.run_lookup(documents(spark, sf), changed).withColumn("p", F.lit("new "))
    return _state(M.upsert(_old_documents(spark, sf), new))


def delete_job(spark, sf):
    return _state(M.delete_jobs(documents(spark, sf), A.visible_projects(spark, sf)))


def clean_all(spark, sf):
    return M.clean_all(documents(spark, sf))[1]


def run_lookup(spark, sf):
    return M.run_lookup(documents(spark, sf), _labelled(spark, sf)).select(*KEY, "n", "d")


def append_documents(spark, sf):
    new = documents(spark, sf).where("number % 3 = 0")
    return _state(M.append_documents(_old_documents(spark, sf), new))


def _rebuild_with_errors(spark, sf):
    """Runs with a known-bad label cannot be stored."""
    runs = A.runs(spark, sf).join(
        A.table(spark, sf, "labels"), F.col("number") == F.col("doc_id"), "left"
    )
    checks = {
        "toxic log": F.coalesce(F.col("toxic"), F.lit(0)) == 0,
        "poor log": F.coalesce(F.col("quality"), F.lit(1)) == 1,
    }
    return M.split_valid(runs, checks)


def split_bad_runs(spark, sf):
    return _rebuild_with_errors(spark, sf)[1]


def rebuild_report(spark, sf):
    errors = _rebuild_with_errors(spark, sf)[1]
    return M.rebuild_report(A.jobs(spark, sf), A.runs(spark, sf), errors)


def rebuild_status(spark, sf):
    return M.rebuild_status(rebuild_report(spark, sf)).select(
        F.col("code").cast("bigint").alias("code"), "message", "running", "never_started", "n_jobs",
        "processed_items",
    )


def status_json(spark, sf):
    clean = M.rebuild_report(A.jobs(spark, sf), A.runs(spark, sf), split_bad_runs(spark, sf))
    return M.status_json(clean)


# -- extensions -------------------------------------------------------------------------------


def _registry(spark, sf):
    registry = FieldRegistry()
    registry.register_text_field("unittest", E.failed_test_text(A.failed_tests(spark, sf)), persist=True)
    registry.register_text_field("artifact", E.artifact_text(A.artifacts(spark, sf)), persist=False)
    return registry


def ext_failed_tests(spark, sf):
    docs = D.build_documents(A.runs(spark, sf), _registry(spark, sf))
    return docs.select(*KEY, F.length("unittest").cast("bigint").alias("n_chars"),
                       _digest("unittest").alias("unittest_md5"))


def ext_artifacts(spark, sf):
    docs = D.build_documents(A.runs(spark, sf), _registry(spark, sf))
    return docs.select(*KEY, F.length("artifact").cast("bigint").alias("n_chars"),
                       _digest("artifact").alias("artifact_md5"))


def _no_thirds(text):
    """Foreign code that cannot read every text."""
    if len(text) % 3 == 0:
        raise ValueError("length")
    return text.replace(" ", "_")


def _failing_registry(spark, sf):
    """One extension that fails on some texts and one whose job fails."""
    guarded = D.guarded_extraction(_no_thirds)

    def some(runs):
        return runs.select(*KEY, guarded("console").alias("e")).select(*KEY, "e.text", "e.error")

    def none(runs):
        broken = F.raise_error(F.concat(F.lit("run "), F.col("number").cast("string")))
        return runs.select(*KEY, broken.cast("string").alias("text"))

    registry = FieldRegistry()
    registry.register_text_field("some", some)
    registry.register_text_field("broken", none)
    return registry


def ext_failing_rows(spark, sf):
    """Documents keep all other fields where an extension fails, with the reason."""
    docs, _ = D.build_documents_isolated(A.runs(spark, sf), _failing_registry(spark, sf))
    return docs.select(*KEY, "p", _digest("some").alias("some_md5"), "some_error", "broken",
                       F.col("broken_error").isNotNull().alias("broken_has_error"))


def ext_failing_report(spark, sf):
    """Texts and failures per extension, counted while they were written."""
    runs = A.runs(spark, sf)
    _, reports = D.build_documents_isolated(runs, _failing_registry(spark, sf))
    report = D.extension_report(reports, runs)
    return report.select("keyword", "n_texts", "n_failed", F.col("error").isNotNull().alias("failed"))


def ext_not_stored(spark, sf):
    """Extension text is searchable: its postings exist although the stored table lacks the field."""
    registry = _registry(spark, sf)
    docs = D.build_documents(A.runs(spark, sf), registry)
    stored = D.stored_documents(docs, registry)
    n_stored = F.lit(int("artifact" in stored.columns)).cast("bigint")
    return (
        P.postings(docs, ["unittest", "artifact"])
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_postings"), F.sum("tf").alias("n_tokens"))
        .withColumn("artifact_stored", n_stored)
    )


def artifact_patterns(spark, sf):
    """Artifact paths by include and exclude patterns."""
    path = F.regexp_replace("url", r"^https?://", "")
    rows = A.table(spark, sf, "pages").select("page_id", path.alias("path"))
    return rows.where(
        path_selected(F.col("path"), "**/en/*, *.example.org/**", "th*/**,**/?5")
    )


# -- explicit predicates ------------------------------------------------------------------------


def _phrases(spark, sf):
    """Successive words of each benchmark item, and each whole item, as a phrase."""
    shapes = ("{w3} {w4} {w5}", "{w3} {w4}", "{all}")
    return A.queries(spark, sf, shapes).withColumnRenamed("q", "phrase")


def phrase_match(spark, sf):
    return predicates.phrase_match(
        documents(spark, sf), _phrases(spark, sf), ["j", "d", "p", "c"], index=index(spark, sf)
    )


def phrase_after_update(spark, sf):
    """Positions follow the documents: an index of outdated ones, brought up to date."""
    old = _old_documents(spark, sf).withColumn("c", F.concat(F.lit("outdated "), F.reverse("c")))
    stale = SearchIndex.build(old, scratch_path(spark, "stale"))
    now = documents(spark, sf)
    updated = stale.update(old, now, scratch_path(spark, "update"))
    return predicates.phrase_match(now, _phrases(spark, sf), ["j", "d", "p", "c"], index=updated)


def _patterns(spark, sf):
    """Patterns cut from benchmark words: beginning, end, middle and one free character."""
    words = A.queries(spark, sf, ("{w3}", "{w4}", "{w5}", "{w4}"))
    kind = F.col("qid") % 100
    pattern = (
        F.when(kind == 0, F.concat(F.substr("q", F.lit(1), F.lit(3)), F.lit("*")))
        .when(kind == 1, F.concat(F.lit("*"), F.expr("right(q, 3)")))
        .when(kind == 2, F.concat(F.lit("*"), F.expr("substr(q, 2, 3)"), F.lit("*")))
        .otherwise(F.concat(F.lit("?"), F.expr("substr(q, 2)")))
    )
    return words.select("qid", F.lit("c").alias("field"), pattern.alias("pattern"))


def wildcard_match(spark, sf):
    return predicates.wildcard_match(index(spark, sf), _patterns(spark, sf))


def wildcard_after_update(spark, sf):
    """The vocabulary's grams follow the documents, too."""
    return predicates.wildcard_match(_updated_index(spark, sf), _patterns(spark, sf))


def number_range(spark, sf):
    docs = documents(spark, sf)
    low = predicates.number_range(docs, high=90).select(*KEY)
    return low.unionByName(predicates.number_range(docs, low=150, high=4000).select(*KEY))


# -- change feed --------------------------------------------------------------------------------


def _documents_of(state):
    return state.select(*KEY, "seq", "d", "p", "c")


def events_latest_state(spark, sf):
    return _documents_of(latest_state(A.run_events(spark, sf)))


def events_job_deleted(spark, sf):
    return job_deletions(A.run_events(spark, sf))


def events_compacted(spark, sf):
    return compacted(A.run_events(spark, sf)).select("project", "number", "seq", "op")


def stream_replay(spark, sf):
    """The events as a stream in several micro-batches, compacted midway; same state as in batch."""
    root = scratch_path(spark, "feed")
    parts = A.run_events(spark, sf)
    for at in range(2):
        parts.where(F.pmod(F.xxhash64("seq"), F.lit(2)) == at).write.parquet(f"{root}/in{at}")
    base = None
    for at in range(2):
        log = ChangeLog(spark, f"{root}/log{at}")
        feed = log.start(
            event_stream(spark, f"{root}/in{at}", files_per_batch=1),
            f"{root}/checkpoint{at}",
            lambda writer: writer.trigger(availableNow=True),
        )
        feed.awaitTermination()
        if at == 0:
            base = log.compact(f"{root}/base")
    return _documents_of(log.current(base))


def feed_with_extension(spark, sf):
    """Events that carry an extension's text, streamed twice into one log under two checkpoints."""
    root, registry = scratch_path(spark, "feed"), _unittest_registry()
    parts = A.run_events(spark, sf).withColumn("unittest", F.concat(F.lit("case "), "p", "c"))
    log = ChangeLog(spark, f"{root}/log", registry)
    for at in range(2):
        parts.where(F.pmod(F.xxhash64("seq"), F.lit(2)) == at).write.parquet(f"{root}/in{at}")
        feed = log.start(
            event_stream(spark, f"{root}/in{at}", registry=registry),
            f"{root}/checkpoint{at}",
            lambda writer: writer.trigger(availableNow=True),
        )
        feed.awaitTermination()
    return log.current().select(*KEY, "seq", "unittest")


QUERIES: dict[str, Query] = {
    "extract_fields": extract_fields,
    "parameter_text": parameter_text,
    "tokenize": tokenize,
    "tokenize_custom": tokenize_custom,
    "tokenize_max_len": tokenize_max_len,
    "stopword_filter": stopword_filter,
    "postings": postings,
    "positions": positions,
    "term_stats": term_stats,
    "field_stats": field_stats,
    "doc_lengths": doc_lengths,
    "index_update": index_update,
    "index_many_updates": index_many_updates,
    "update_with_stop_words": update_with_stop_words,
    "update_with_pieces": update_with_pieces,
    "update_keeps_pieces": update_keeps_pieces,
    "index_pieces": index_pieces,
    "query_pieces": query_pieces,
    "query_escape": query_escape,
    "query_occur": query_occur,
    "query_validity": query_validity,
    "query_job_mode": query_job_mode,
    "query_show_console": query_show_console,
    "match_term": _matches("{w3}"),
    "match_all": _matches("{w3} {w4} {w5}", "{w3} AND {w5}"),
    "match_any": _matches("{w3} OR {w4} OR {w5}", "{w3} AND {w4} OR {w5}"),
    "match_whole_items": _matches("{all}", "{any}"),
    "match_not": _matches("{w3} NOT {w4}", "NOT {w3}", "-c:{w3} {w4}", "{w3} OR NOT {w5}"),
    "match_field": _matches("c:{w3} j:src1", "p:fr c:{w4}", "n:7", "d:12", "+c:{w3} !p:en"),
    "match_unknown_field": _matches("zz:{w3} {w4}", "zz:{w3} OR {w4}", "NOT zz:{w3} {w4}"),
    "match_multi_token": _matches("c:{w3}/{w4}", "{w3}-{w5}", "j:src1/src1 {w3}", 'c:"{w3} {w4}"'),
    "match_job_mode": _matches("src1 {w3}", "src1 {w3} OR {w4}", "src2 NOT {w3}", "src1 AND {w3}"),
    "match_every_shape": _matches(*A.SHAPES),
    "bm25_topk": bm25_topk,
    "first_hit": first_hit,
    "page_2_keyset": page_2_keyset,
    "rank_every_hit": rank_every_hit,
    "page_navigation": page_navigation,
    "page_dedupe": page_dedupe,
    "page_order": page_order,
    "page_labels": page_labels,
    "name_and_text_union": name_and_text_union,
    "suggestions": suggestions,
    "hit_url": hit_url,
    "orphan_docs": orphan_docs,
    "visible_hits": visible_hits,
    "visible_first": visible_first,
    "fragments": fragments,
    "fragments_br": fragments_br,
    "search_pages": search_pages,
    "search_stored_parts": search_stored_parts,
    "hits_round_trip": hits_round_trip,
    "rebuild_overwrite": rebuild_overwrite,
    "rebuild_preserve": rebuild_preserve,
    "rebuild_subset": rebuild_subset,
    "validate_jobs": validate_jobs,
    "empty_jobs": empty_jobs,
    "job_labels": job_labels,
    "remove_run": remove_run,
    "upsert_run": upsert_run,
    "delete_job": delete_job,
    "clean_all": clean_all,
    "run_lookup": run_lookup,
    "append_documents": append_documents,
    "split_bad_runs": split_bad_runs,
    "rebuild_report": rebuild_report,
    "rebuild_status": rebuild_status,
    "status_json": status_json,
    "ext_failed_tests": ext_failed_tests,
    "ext_artifacts": ext_artifacts,
    "ext_not_stored": ext_not_stored,
    "ext_failing_rows": ext_failing_rows,
    "ext_failing_report": ext_failing_report,
    "artifact_patterns": artifact_patterns,
    "phrase_match": phrase_match,
    "phrase_after_update": phrase_after_update,
    "wildcard_match": wildcard_match,
    "wildcard_after_update": wildcard_after_update,
    "number_range": number_range,
    "events_latest_state": events_latest_state,
    "events_job_deleted": events_job_deleted,
    "events_compacted": events_compacted,
    "stream_replay": stream_replay,
    "feed_with_extension": feed_with_extension,
}
