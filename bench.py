"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from runsift.plans import registered as R  # noqa: E402
from runsift.plans.search import Searcher  # noqa: E402
from runsift.session import scratch_path  # noqa: E402
from runsift.sources import adapters as A  # noqa: E402
from runsift.sources.index_tables import SearchIndex  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("runsift-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    docs = R.documents(spark, SF_DIR)
    built: list[SearchIndex] = []

    def build() -> None:
        built.append(SearchIndex.build(docs, scratch_path(spark, "bench-index")))

    def searcher() -> Searcher:
        return Searcher(built[-1], docs)

    all_words = A.queries(spark, SF_DIR, ("{w3} {w4} {w5}",))
    any_word = A.queries(spark, SF_DIR, ("{w3} OR {w4} OR {w5}",))
    shapes = A.queries(spark, SF_DIR)
    runs = A.runs(spark, SF_DIR)
    some = docs.where("number % 100 = 0")
    changed = some.withColumn("c", F.concat("c", F.lit(" changed")))
    steps = {
        "index_build": build,
        "search_all_words": lambda: drain(searcher().ranked(all_words)),
        "search_any_word": lambda: drain(searcher().ranked(any_word)),
        "search_every_shape": lambda: drain(searcher().ranked(shapes)),
        "search_pages": lambda: drain(searcher().pages(any_word, 3)),
        "search_with_fragments": lambda: drain(searcher().search(all_words, runs, R.ROOT_URL)),
        "phrase_match": lambda: drain(R.phrase_match(spark, SF_DIR)),
        "wildcard_match": lambda: drain(R.wildcard_match(spark, SF_DIR)),
        "index_update": lambda: built[-1].update(some, changed, scratch_path(spark, "bench-update")),
        "rebuild_overwrite": lambda: drain(R.rebuild_overwrite(spark, SF_DIR)),
        "ext_failed_tests": lambda: drain(R.ext_failed_tests(spark, SF_DIR)),
        "events_latest_state": lambda: drain(R.events_latest_state(spark, SF_DIR)),
    }
    R.index(spark, SF_DIR)
    times: dict[str, float] = {}
    for name, step in steps.items():
        samples = []
        for _ in range(2):
            start = time.perf_counter()
            step()
            samples.append(time.perf_counter() - start)
        times[name] = round(min(samples), 3)
        print(name, [round(s, 2) for s in samples], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "median": round(statistics.median(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
