from pyspark.sql import functions as F

from runsift import SearchIndex, Searcher
from runsift.operators import documents as D
from runsift.operators import maintain as M
from runsift.schemas import RUNS
from runsift.session import scratch_path
from runsift.sources import document_table, logs
from runsift.streaming.changes import ChangeLog, compacted, event_stream, latest_state, live, merge
from runsift.sources import adapters as A


def echo_hits(spark, docs):
    searcher = Searcher(SearchIndex.build(docs, scratch_path(spark, "t"), doc_buckets=4), docs)
    return searcher.pages(spark.createDataFrame([(0, "echo")], "qid bigint, q string")).count()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_live_then_rebuilt(spark, runs_of_three, three_jobs):
    empty = D.build_documents(spark.createDataFrame([], RUNS))
    assert echo_hits(spark, empty) == 0
    docs = M.append_documents(empty, D.build_documents(runs_of_three))
    assert echo_hits(spark, docs) == 3
    rebuilt = M.rebuild_overwrite(docs, runs_of_three, three_jobs)
    assert rebuilt.count() == 3
    assert echo_hits(spark, rebuilt) == 3
    report = M.rebuild_report(three_jobs, runs_of_three, runs_of_three.limit(0).withColumn("reason", F.lit("")))
    status = M.rebuild_status(report).first()
    assert (status.code, status.message, status.processed_items) == (0, "Completed without errors", 3)


def test_rebuild_of_an_empty_table(spark, runs_of_three, three_jobs):
    no_runs = spark.createDataFrame([], RUNS)
    empty = D.build_documents(no_runs)
    assert echo_hits(spark, M.rebuild_overwrite(empty, no_runs, three_jobs)) == 0
    assert echo_hits(spark, M.rebuild_overwrite(empty, runs_of_three, three_jobs)) == 3


def test_rebuild_invariants(spark, sf):
    runs, jobs = A.runs(spark, sf), A.jobs(spark, sf)
    old = D.build_documents(runs).where("number % 3 != 0")
    once = M.rebuild_overwrite(old, runs, jobs)
    twice = M.rebuild_overwrite(once, runs, jobs)
    assert rows(once) == rows(twice)
    assert rows(M.rebuild_preserve(once, runs, jobs)) == rows(once)


def test_gone_jobs_lose_their_documents(spark, runs_of_three, three_jobs):
    docs = D.build_documents(runs_of_three)
    stale = docs.withColumn("project", F.lit("project2"))
    both = M.append_documents(docs, stale)
    for rebuild in (M.rebuild_overwrite, M.rebuild_preserve):
        assert rows(rebuild(both, runs_of_three, three_jobs)) == rows(docs)


def test_deleting_a_job_leaves_longer_names(spark, runs_of_three):
    docs = D.build_documents(runs_of_three)
    other = docs.withColumn("project", F.lit("project1 test"))
    kept = M.delete_jobs(
        M.append_documents(docs, other), spark.createDataFrame([("project1",)], "project string")
    )
    assert rows(kept) == rows(other)


def test_upsert_and_lookup(spark, runs_of_three):
    docs = D.build_documents(runs_of_three)
    new = docs.where("number = 2").withColumn("c", F.lit("new"))
    changed = M.upsert(docs, new)
    assert changed.count() == 3
    assert [r.c for r in M.run_lookup(changed, new).collect()] == ["new"]
    assert M.exists(changed, "project1", 2) and not M.exists(changed, "project1", 9)
    emptied, report = M.clean_all(changed)
    assert emptied.count() == 0 and report.first().current == 3


def test_one_bad_run_is_reported_and_the_rest_goes_on(spark, runs_of_three, three_jobs):
    good, errors = M.split_valid(runs_of_three, {"no log": F.col("number") != 2})
    assert good.count() == 2
    report = {r.full_name: r for r in M.rebuild_report(three_jobs, runs_of_three, errors).collect()}
    assert report["project1"].state == "COMPLETE_WITH_ERROR" and report["project1"].reason == "no log"
    assert report["project2"].state == "COMPLETE"
    status = M.rebuild_status(M.rebuild_report(three_jobs, runs_of_three, errors)).first()
    assert (status.code, status.message) == (2, "no log")


def test_request_names(spark, three_jobs):
    typed = spark.createDataFrame([("  project1   nope ",)], "t string")
    names = typed.select(F.explode(M.requested_names(F.col("t"))).alias("name"))
    assert [r.name for r in M.unknown_names(names, three_jobs).collect()] == ["nope"]
    assert [r.full_name for r in M.jobs_named(three_jobs, names).collect()] == ["project1"]


def test_stored_documents_by_part(spark, sf):
    docs = D.build_documents(A.runs(spark, sf))
    path = scratch_path(spark, "docs")
    document_table.write_documents(docs, path, parts=4)
    stored = document_table.read_documents(spark, path)
    assert rows(stored.select(docs.columns)) == rows(docs)
    index = SearchIndex.build(docs, scratch_path(spark, "t"), doc_buckets=4)
    queries = A.queries(spark, sf, ("{w3} {w4}",))
    found = Searcher(index, stored, doc_parts=4).search(queries, A.runs(spark, sf), "http://ci")
    plain = Searcher(index, docs).search(queries, A.runs(spark, sf), "http://ci")
    columns = ["qid", "rank", "search_name", "url", "fragments"]
    assert rows(found.select(columns)) == rows(plain.select(columns))
    out = scratch_path(spark, "hits")
    document_table.write_hits(found, out, "json")
    assert spark.read.json(out).count() == found.count()


def event(seq, op, project="p", number=1, text="x"):
    return (seq, op, project, number, project, str(number), "#", "", text)


def state(df):
    return {(r.project, r.number): r.c for r in df.collect()}


def test_feed_rules(spark):
    from runsift.schemas import RUN_EVENTS

    events = spark.createDataFrame(
        [
            event(1, "completed", text="a"),
            event(2, "changed", text="b"),
            event(1, "completed", number=2, text="c"),
            event(3, "run_deleted", number=2),
            event(4, "completed", "q", 1, "d"),
            event(5, "job_deleted", "q", None),
            event(6, "completed", "q", 2, "e"),
            event(3, "completed", "q", 3, "late"),
        ],
        RUN_EVENTS,
    )
    assert state(latest_state(events)) == {("p", 1): "b", ("q", 2): "e"}
    assert rows(compacted(compacted(events))) == rows(compacted(events))
    late = spark.createDataFrame(
        [event(1, "completed", number=2, text="older"), event(4, "completed", "q", 9, "older"),
         event(9, "changed", text="newer")],
        RUN_EVENTS,
    )
    merged = merge(compacted(events), late)
    assert state(live(merged)) == {("p", 1): "newer", ("q", 2): "e"}
    assert state(live(merge(merged, events))) == state(live(merged))


def test_stream_equals_batch_and_replay_changes_nothing(spark, sf):
    events = A.run_events(spark, sf)
    root = scratch_path(spark, "feed")
    events.repartition(5).write.parquet(f"{root}/in")
    log = ChangeLog(spark, root)
    for checkpoint in ("one", "two"):  # the second run starts over and replays every batch
        feed = log.start(
            event_stream(spark, f"{root}/in", files_per_batch=2),
            f"{root}/{checkpoint}",
            lambda writer: writer.trigger(availableNow=True),
        )
        feed.awaitTermination()
        assert rows(log.current()) == rows(latest_state(events).select(log.current().columns))


def test_log_and_artifact_files(spark, tmp_path):
    for project, number, body in (("app", 1, "ok é\n".encode()), ("f/job", 2, b"bad \xff byte")):
        folder = tmp_path / project / str(number)
        (folder / "archive" / "out").mkdir(parents=True)
        (folder / "log").write_bytes(body)
        (folder / "archive" / "out" / "a.txt").write_bytes("grün".encode("cp1252"))
        (folder / "archive" / "skip.bin").write_bytes(b"\x00")
    got = {(r.project, r.number): r.console for r in logs.read_console_logs(spark, str(tmp_path)).collect()}
    assert got == {("app", 1): "ok é\n", ("f/job", 2): "bad \ufffd byte"}
    lines = {(r.project, r.number, r.field, r.text) for r in logs.read_log_lines(spark, str(tmp_path)).collect()}
    assert lines == {("app", 1, "c", "ok é"), ("f/job", 2, "c", "bad \ufffd byte")}
    files = logs.read_artifacts(spark, str(tmp_path), "**/*.txt, *.bin", "skip.*", "cp1252")
    assert {(r.project, r.number, r.path, r.content) for r in files.collect()} == {
        ("app", 1, "out/a.txt", "grün"),
        ("f/job", 2, "out/a.txt", "grün"),
    }


def test_unreadable_log_keeps_its_run(spark, tmp_path):
    for number, text in ((1, "fine"), (2, "spoilt")):
        folder = tmp_path / "app" / str(number)
        folder.mkdir(parents=True)
        (folder / "log").write_text(text)
    # A checksum file that does not fit makes the reader fail for this log alone.
    (tmp_path / "app" / "2" / ".log.crc").write_bytes(b"crc\0" + (512).to_bytes(4, "big") + bytes(4))
    got = logs.read_console_logs(spark, str(tmp_path))
    assert {(r.project, r.number, r.console) for r in got.collect()} == {("app", 1, "fine"), ("app", 2, None)}


def test_maintenance_events_equal_table_operations(spark, sf):
    from runsift.streaming import changes as C

    runs, jobs = A.runs(spark, sf), A.jobs(spark, sf)
    docs = D.build_documents(runs)
    old = docs.where("number % 3 != 0").withColumn("p", F.lit("old "))
    some = jobs.where("name IN ('src1', 'src2', 'idle-src1')")
    gone = docs.where("number % 7 = 0").select("project", "number")
    drop = spark.createDataFrame([("src4",)], "project string")
    table = M.rebuild_overwrite(old, runs, some)
    table = M.delete_jobs(M.remove_runs(table, gone), drop)
    log = ChangeLog(spark, scratch_path(spark, "log"))
    steps = [
        C.put_events(old, 1),
        C.rebuild_events(runs, some, 2),
        C.remove_events(gone, 4),
        C.drop_events(drop, 5),
    ]
    for at, step in enumerate(steps):
        log.append(step, at)
    assert rows(log.current().select(docs.columns)) == rows(table)


def test_index_follows_the_feed(spark, sf):
    from runsift.streaming.changes import changed_documents

    events = A.run_events(spark, sf).where("project < 'u3'")
    first, then = events.where("seq % 10 < 6"), events.where("seq % 10 >= 6")
    before, after = latest_state(first), latest_state(first.unionByName(then))
    index = SearchIndex.build(before.drop("seq"), scratch_path(spark, "t"), doc_buckets=4)
    old, new = changed_documents(before, after, then)
    updated = index.update(old, new, scratch_path(spark, "t"))
    rebuilt = SearchIndex.build(after.drop("seq"), scratch_path(spark, "t"), doc_buckets=4)
    columns = ["project", "number", "field", "term", "tf", "dl"]
    assert rows(updated.postings.select(columns)) == rows(rebuilt.postings.select(columns))
    assert rows(updated.term_stats) == rows(rebuilt.term_stats)
    assert rows(updated.field_stats) == rows(rebuilt.field_stats)


def test_streams_and_manual_batches_share_a_log(spark):
    """A second checkpoint, or a batch stored by hand under the same number, replaces nothing."""
    root = scratch_path(spark, "log")
    log = ChangeLog(spark, root)
    schema = "seq long, op string, project string, number long, c string"
    for at in range(2):
        rows = spark.createDataFrame([(at, "completed", "p", at, f"text {at}")], schema)
        rows.write.parquet(f"{root}/in{at}")
        feed = log.start(
            event_stream(spark, f"{root}/in{at}"), f"{root}/checkpoint{at}",
            lambda writer: writer.trigger(availableNow=True),
        )
        feed.awaitTermination()
    log.append(spark.createDataFrame([(9, "completed", "p", 9, "by hand")], schema), 0)
    assert {r.c for r in log.current().collect()} == {"text 0", "text 1", "by hand"}


def test_log_paths_below_any_root(spark):
    rows = spark.createDataFrame([("hdfs://host:8020/a+b/app/1/log",)], "path string")
    for root in ("hdfs:///a+b", "hdfs://other/a+b/", "/a+b"):
        assert rows.select(logs._relative(F.col("path"), root)).first()[0] == "app/1/log"


def test_elapsed_time_in_status(spark, sf):
    report = M.rebuild_report(A.jobs(spark, sf), A.runs(spark, sf), A.runs(spark, sf).selectExpr("project", "number", "'x' AS reason").limit(0))
    assert M.rebuild_status(report, 61_999).first().elapsed_s == 61
    assert "elapsed_s" not in M.rebuild_status(report).columns
