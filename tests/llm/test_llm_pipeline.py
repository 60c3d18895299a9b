"""The corpus pipeline against brute force, stage by stage, and its awkward inputs."""

import re

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from runsift.llm import packing, quality, tokens
from runsift.llm.common import table
from runsift.session import written


def test_pipeline_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    scored = quality.scored(docs, table(spark, sf, "labels")).where("predicted = 1")
    good = {r.doc_id for r in scored.collect()}
    left = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    lines = brute.deduplicated_lines(left)
    left = [(i, lines[i][2]) for i, _ in left]
    prints = [(i, brute.simhash64(t)) for i, t in left]
    stays = set(brute.linked_components(prints))
    flat = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [flat(r.text) for r in table(spark, sf, "benchmark").collect()]
    left = [(i, t) for i, t in left if i in stays and not any(item in flat(t) for item in items)]
    encoded = tokens.encoder(tokens.vocabulary_path()).ids([t for _, t in left])
    want = {
        (i, k, at, len(ids[at : at + 4096]), tokens.crc32_of(ids[at : at + 4096]))
        for (i, _), ids in zip(left, encoded, strict=True)
        for k, at in enumerate(range(0, len(ids), packing.CAPACITY))
    }
    got = corpus_pipeline.run(spark, sf).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want
    assert len(got) == len(want)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= packing.CAPACITY
    assert len(ends) <= 1 + -(-sum(r.length for r in got) // packing.CAPACITY)


@pytest.mark.parametrize("rows", [0, 40])
def test_stages_pass_other_columns_and_nulls(spark, sf, rows):
    docs = table(spark, sf, "documents").limit(rows)
    odd = docs.withColumns({"score": F.lit(None).cast("double"), "h1": F.lit("x"), "stays_id": F.lit(1), "tie": F.lit("t")})
    nulls = spark.createDataFrame([(None, None), (None, "plain words of no file"), (3, None)], "doc_id long, text string")
    odd = odd.unionByName(nulls.limit(3 if rows else 0), allowMissingColumns=True)
    now = written(odd, "odd-docs")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, sf)
        assert after.columns == odd.columns, name
        now = written(after, f"odd-{name}")
    assert corpus_pipeline.STAGES[-1][1](spark, now, sf).count() >= now.count()


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
