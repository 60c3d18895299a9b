"""The ten operators against brute force, on small tables with all the awkward rows."""

import functools
import math
import re
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runsift.llm import (
    chat,
    decontaminate,
    fingerprints,
    licenses,
    line_dedup,
    packing,
    quality,
    registered,
    simhash_dedup,
    token_files,
    tokens,
    url_filter,
)
from runsift.llm.common import table
from runsift.llm.components import components
from runsift.session import scratch_path, written

DOCS = "doc_id long, text string, lang string, score double, h1 long, line string, fp long, tie string, lost_lines string"
PROSE = "the quick brown fox jumps over the lazy dog while nobody is looking at it"


def docs_of(spark, rows):
    """(doc_id, text) rows with other columns whose names operators use inside, some of them null."""
    full = [(i, t, None, 0.5, None, "x", 7, None, "y") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def awkward():
    """Nulls, empty and long texts, exact and near copies, repeated rows, shared ids, marks and other scripts."""
    long_text = " ".join(f"word{i % 977} and{i}" for i in range(20_000))
    rows = [
        (5, None),
        (3, ""),
        (8, " \t\n "),
        (None, PROSE),
        (None, None),
        (1, PROSE),
        (2, PROSE.upper()),
        (4, PROSE + "!"),
        (4, PROSE + "!"),
        (6, PROSE + "\n" + PROSE.replace("quick", "quack")),
        (7, PROSE.replace("dog", "dogs") + "\nshort\nshort"),
        (9, "Été ça và là 日本語 テスト \U0001f600 ﬁn"),
        (10, "one"),
        (11, "one two"),
        (12, long_text),
        (13, long_text + " end"),
        (14, "x" * 5000),
    ]
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return written(docs_of(spark, rows), "test-docs")


@pytest.fixture(scope="module")
def no_docs(spark):
    return docs_of(spark, [])


@pytest.fixture(scope="module")
def given_docs(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


# 1. URL filters


def test_urls_are_judged_as_each_alone(spark, sf):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in registered.op1_url_filter(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    assert got == {r.page_id: brute.judged_url(r.url) for r in pages}


URLS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "http://NET/",
    "http://a.NET/x?y",
    "http://net",
    "http://net?x/",
    "https://example.net/en/1",
    "https://m.example.net/en",
    "ftp://example.com/de/a#b",
    "http://examplexcom/de/",
    "http://badexample.com/de/",
    "http://x.org/fr/é",
    "http://org/fr/",
    "http://..net//",
    "http://a://net/",
]


@pytest.mark.parametrize("max_bytes", [1 << 20, 40])
def test_awkward_urls_and_shards(spark, max_bytes):
    rules = spark.createDataFrame(brute.RULES, "action string, host string, path string")
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)] * 2, "page_id long, url string, host string")
    got = url_filter.judge_urls(pages, rules, max_bytes=max_bytes).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute.judged_url(URLS[r.page_id])


def test_url_rules_empty_or_contradictory(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "action string, host string, path string")
    assert [r.verdict for r in url_filter.judge_urls(pages, none, default="block").collect()] == ["block"]
    assert url_filter.judge_urls(pages.limit(0), none).count() == 0
    both = spark.createDataFrame([("block", "net", "/"), ("allow", "NET", "/")], none.schema)
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages, both)


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 20_000, 7).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_filter.build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    table = url_filter._hashed(universe).toPandas()
    got = cascade.contains(table.h1.to_numpy(), table.h2.to_numpy())
    assert (got == (table.key.str[1:].astype(int) % 7 == 0)).all()


# 2. Chat


def test_chat_round_trip(spark):
    texts = ["\\### Assistant: </turn> ok", "##", "####</turn>\n", "\\", "\\\\n", None, "", "é\n</", "$1 \\n"]
    rows = [(1, i, ("user", "assistant", "sys\ntem\\n", None)[i % 4], t) for i, t in enumerate(texts)]
    rows += [(2, 0, "user", "alone"), (3, 0, "assistant", "only"), (None, 1, "assistant", "b"), (None, None, "user", "a")]
    rows += [(4, 1, "assistant", "twice")] * 2
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    made = chat.examples(table)
    for r in made.where("loss_start < loss_end").collect():
        assert r.text[: r.loss_start].startswith("### ") and r.text[r.loss_end :] == chat.TURN_END
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        assert [(t.role, t.text) for t in back[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert back[conv].loss_text == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert chat.examples(table.limit(0)).count() == 0


# 3. Packing


def sequences_hold(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_of_documents(spark, docs, rows, no_docs):
    got = packing.pack_documents(docs).collect()
    encoded = list(tokens.encoder(tokens.vocabulary_path()).ids([t for _, t in rows]))
    want = sorted(
        (str(i), k, at, len(ids[at : at + 4096]), tokens.crc32_of(ids[at : at + 4096]))
        for (i, _), ids in zip(rows, encoded, strict=True)
        for k, at in enumerate(range(0, len(ids), 4096))
    )
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    n = sequences_hold(got, 4096)
    assert n <= -(-sum(r.length for r in got) // 4096) + 1
    assert packing.pack_documents(no_docs).count() == 0


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(1, 50), max_size=200))
def test_every_plan_places_every_piece_once(lengths):
    lengths = np.array(lengths, np.int64)
    plan = packing.packing_plan(np.bincount(lengths, minlength=51), 50, classes=6)
    order = np.argsort(lengths, kind="stable")
    rank = np.zeros(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths)) - np.searchsorted(lengths[order], lengths[order])
    sequence, offset = packing.placed_at(plan, lengths, rank) if len(lengths) else (lengths, lengths)
    cells = {(s, o + i) for s, o, n in zip(sequence, offset, lengths, strict=True) for i in range(n)}
    assert len(cells) == lengths.sum() and all(c < 50 for _, c in cells)


def test_configurations_beat_plain_best_fit():
    lengths = np.repeat([1639, 1638, 1229, 1228, 819], 4000)
    counts = np.bincount(lengths, minlength=4097)
    plan = packing.packing_plan(counts)
    used = (plan["sequence"]).max() + 1
    plain = packing._Packing(counts.astype(np.int64))
    plain.fill(4096)
    assert used < sum(g.times for g in plain.groups)
    assert used <= 1.03 * -(-lengths.sum() // 4096)


# 4. Fingerprints


def test_fingerprints_of_edited_texts(spark, sf, given_docs):
    got = {r.doc_id: r for r in registered.op4_fingerprints(spark, sf).collect()}
    edited = brute.edited(given_docs)
    for i, text in given_docs:
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text or ""), brute.sha256(edited[i]))
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.95 * len(got)


def test_fingerprints_of_awkward_rows(spark, docs, rows, no_docs):
    got = fingerprints.document_fingerprints(docs).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert len(r.fingerprint) == 32
        if r.doc_id in (5, 3, 8):
            assert r.fingerprint == "0" * 32
        by_text.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert by_text[1] == by_text[2] <= by_text[None]
    four = [r for r in got if r.doc_id == 4]
    assert sorted(r.near_next == 1.0 for r in four) == [False, True]
    assert fingerprints.document_fingerprints(no_docs).count() == 0
    one = fingerprints.document_fingerprints(docs.where("doc_id = 1")).collect()
    assert [r.near_next for r in one] == [1.0]
    cut = len(PROSE) // 3
    assert one[0].edited_sha256 == brute.sha256(PROSE[: len(PROSE) - cut] + PROSE[:cut])


def test_block_tables_find_all_within_radius(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63, (40, 2))
    flips = [(int(a) ^ (1 << int(rng.integers(62))), int(b) ^ (1 << int(rng.integers(62)))) for a, b in base]
    points = [tuple(map(int, p)) for p in base] + flips
    table = spark.createDataFrame(points, "fp_high long, fp_low long")
    got = {(r.q_high, r.q_low, r.fp_high, r.fp_low) for r in fingerprints.within_radius(table, table, 3).collect()}
    bits = lambda x: (x & (2**64 - 1)).bit_count()
    want = {(*p, *q) for p in points for q in points if bits(p[0] ^ q[0]) + bits(p[1] ^ q[1]) <= 3}
    assert got == want


# 5. Token files


@pytest.mark.parametrize("memory", [None, 2000])
def test_ids_of_whole_texts(spark, sf, monkeypatch, memory):
    """All texts of a table, also with a memory so small that most chunks are forgotten and learnt again."""
    from tokenizers import Tokenizer

    if memory:
        monkeypatch.setattr(tokens, "MEMO_CHUNKS", memory)
    texts = [r.text or "" for r in table(spark, sf, "documents").collect()]
    own = Tokenizer.from_file(tokens.vocabulary_path()).encode_batch(texts, add_special_tokens=False)
    encoder, got = tokens.TextEncoder(tokens.vocabulary_path()), []
    for begin in range(0, len(texts), 20):
        got += encoder.ids(texts[begin : begin + 20], end_id=None)
    assert [g.tolist() for g in got] == [e.ids for e in own]


def test_token_files(spark, docs, rows, no_docs):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs, path)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    encoded = list(tokens.encoder(tokens.vocabulary_path()).ids([t for _, t in order]))
    starts = np.cumsum([0] + [len(i) for i in encoded])
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [
        (i, s, len(e)) for (i, _), s, e in zip(order, starts.tolist(), encoded, strict=False)
    ]
    assert all(list(r.ids) == e.tolist() for r, e in zip(got, encoded, strict=True))
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    wanted = spark.createDataFrame([(1,), (12,)], "doc_id long")
    short = {r.doc_id: list(r.ids) for r in token_files.read_documents(wanted, path).collect()}
    assert short == {r.doc_id: list(r.ids) for r in got if r.doc_id in (1, 12)}
    empty = scratch_path(spark, "test-tokens")
    token_files.write_tokens(no_docs, empty)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_wide_ids_are_stored_whole():
    ids = np.array([1, 70_000, 2**32 - 1], np.uint32)
    assert (token_files.deserialised(token_files.serialised(ids)) == ids).all()


TOKENIZER_TEXT = st.text(st.characters(codec="utf-8"), max_size=60) | st.text("aAbB .,!'s\t\nßİΣé\u0301##", max_size=40)


@functools.cache
def plain_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


@settings(deadline=None, max_examples=300)
@given(st.lists(TOKENIZER_TEXT, max_size=5))
def test_ids_are_the_tokenizers_own(texts):
    plain = plain_tokenizer()
    got = tokens.encoder(tokens.vocabulary_path()).ids(texts, end_id=None)
    assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


# 6. Line dedup


def result_of(df):
    return {r.doc_id: (r.lines_kept, r.lines_dropped, r.text or "") for r in df.collect()}


def test_lines_against_every_earlier_line(spark, sf, given_docs):
    assert result_of(registered.op6_line_dedup(spark, sf)) == brute.deduplicated_lines(given_docs)


@pytest.mark.parametrize("min_chars", [0, 5])
def test_lines_within_one_edit(spark, min_chars):
    texts = ["abcdefgh", "abcdefg", "abcdefgx", "xbcdefgh", "abcdeffgh", "bcdefgh", "abcd", "abXd", "éàü ß", "éaü ß", "aaaa", "aaa", "aaaaaa"]
    rows = [(i, "\n".join(texts[i : i + 3])) for i in range(len(texts))] + [(50, ""), (51, None), (52, "abcdefgh\n\nabcdefgh")]
    got = result_of(line_dedup.deduplicated(docs_of(spark, rows), min_chars))
    assert got == brute.deduplicated_lines(rows, min_chars)


def test_lines_of_awkward_rows(spark, docs, rows, no_docs):
    got = line_dedup.deduplicated(docs)
    assert got.columns == [*docs.columns, "lines_kept", "lines_dropped"]
    found = got.collect()
    assert len(found) == len(rows)
    assert {r.text for r in found if r.doc_id == 1} == {""}
    assert {r.text for r in found if r.doc_id is None} == {PROSE, None}
    assert line_dedup.deduplicated(no_docs).count() == 0
    plain = line_dedup.deduplicated(docs, max_edits=0).where("doc_id = 7").first()
    assert plain.text.startswith(PROSE.replace("dog", "dogs"))


def test_lines_of_rows_that_share_an_id(spark):
    first, near = "a line of over thirty-two characters, twice", "a line of over thirty-two characters, twicE"
    rows = [(None, f"{first}\none"), (None, f"{near}\ntwo"), (None, None), (7, f"{first}\nmenu\n \t\n\nmenu"), (7, f"menu\n \t\n{near}x\nMenu")]
    texts = docs_of(spark, rows + rows[-1:]).withColumn("tie", F.col("text"))
    found = line_dedup.deduplicated(texts).collect()
    assert len(found) == len(rows) + 1
    want = brute.deduplicated_rows(rows)
    assert {(r.doc_id, r.tie): (r.lines_kept, r.lines_dropped, r.text or "") for r in found} == want
    # Of the four long lines the first stays; short ones go only where they are equal.
    assert sum(dropped for _, dropped, _ in want.values()) == 3 + 2


def test_many_lines_with_one_variant(spark):
    rows = [(i, f"this line is the same but for one mark: {chr(0x4E00 + i)}") for i in range(300)]
    got = result_of(line_dedup.deduplicated(docs_of(spark, rows)))
    assert sum(k for k, _, _ in got.values()) == 1 and got[0][0] == 1


def test_fingerprint_bits_and_likeness_against_plain_votes(spark, sf, given_docs):
    texts = {doc_id: text for doc_id, text in given_docs if len(text or "") < 20_000}
    edited, order = brute.edited(given_docs), sorted((doc_id for doc_id, _ in given_docs), reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))

    def alike(a, b):
        return max(0.0, math.cos(sum((x ^ y).bit_count() for x, y in zip(a, b, strict=True)) * math.pi / 128))

    for r in registered.op4_fingerprints(spark, sf).collect():
        if r.doc_id not in texts or following[r.doc_id] not in texts:
            continue
        own, other = brute.fingerprint128(texts[r.doc_id]), brute.fingerprint128(edited[r.doc_id])
        assert r.fingerprint == "%016x%016x" % own and r.edited_fingerprint == "%016x%016x" % other
        assert abs(r.near_edited - alike(own, other)) < 1e-9
        assert abs(r.near_next - alike(own, brute.fingerprint128(texts[following[r.doc_id]]))) < 1e-9


# 7. Quality


def test_quality_on_held_out_labels(spark, sf):
    # The smallest tables hold too few labels to judge by; the next ones are always there.
    sf = "/root/testdata/sf0.01"
    got = registered.op7_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = got.where("held_out").join(labels, "doc_id").collect()
    assert len(judged) > 50
    assert sum(r.predicted == r.quality for r in judged) >= 0.95 * len(judged)
    for r in got.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7)


def test_quality_votes_against_plain_votes(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fitted(docs, quality.learnable(labels))
    known = [(vector.astype(float), label) for vector, label in zip(model.labelled, model.labels, strict=True)]
    k, prior = min(quality.NEIGHBOURS, len(known)), sum(label for _, label in known) / len(known)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in registered.op7_quality(spark, sf).collect():
        own = model.latent(quality.term_counts(texts[r.doc_id])[None, :])[0].astype(float)
        near = sorted(((float(own @ vector), label) for vector, label in known), reverse=True)
        least = near[k - 1][0]
        # Which of equally near neighbours vote is free, so the score lies between their least and greatest vote.
        sure = [(c, label) for c, label in near if c > least + 1e-5]
        tied = sorted(label for c, label in near if abs(c - least) <= 1e-5)
        free = k - len(sure)
        ends = []
        for chosen in (tied[:free], tied[len(tied) - free :]):
            votes = [(max(c, 0.0) ** 2, label) for c, label in sure + [(least, label) for label in chosen]]
            total = sum(w for w, _ in votes) + quality.PRIOR_WEIGHT
            ends.append((sum(w * label for w, label in votes) + quality.PRIOR_WEIGHT * prior) / total)
        assert ends[0] - 1e-3 <= r.score <= ends[1] + 1e-3, r.doc_id


def test_quality_of_awkward_rows(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (9, 0), (4, None), (None, 1), (77, 1), (1, 0)], "doc_id long, quality int")
    got = quality.scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = quality.scored(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.scored(no_docs, labels).count() == 0
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns


# 8. SimHash


def test_simhash_components(spark, sf, given_docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registered.op8_simhash_dedup(spark, sf).collect()}
    prints = [(i, brute.simhash64(t)) for i, t in given_docs]
    want = zip(prints, brute.linked_components(prints), strict=True)
    assert got == {i: (f"{fp:016x}", c) for (i, fp), c in want}


def test_simhash_of_awkward_rows(spark, docs, rows, no_docs):
    got = simhash_dedup.near_duplicates(docs)
    prints = [(i, brute.simhash64(t)) for i, t in rows]
    want = sorted((str(i), f"{fp:016x}", str(c)) for (i, fp), c in zip(prints, brute.linked_components(prints), strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got.collect()) == want
    assert simhash_dedup.near_duplicates(no_docs).count() == 0
    one = simhash_dedup.one_of_each(docs)
    assert one.columns == docs.columns
    assert one.count() == len({c for *_, c in want})


@pytest.mark.parametrize("subtree_rows", [1 << 19, 230])
def test_trie_join_finds_every_link(spark, subtree_rows):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**64, 60, dtype=np.uint64)
    near = [c ^ np.uint64(sum(1 << int(b) for b in rng.integers(0, 64, n))) for c in centres for n in (1, 2, 3, 4, 5)]
    prints = np.unique(np.concatenate([centres, np.array(near, np.uint64), np.arange(200, dtype=np.uint64)]))
    table = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in components(simhash_dedup.linked(table, 3, subtree_rows)).collect()}
    signed = prints.view(np.int64).tolist()
    want = brute.linked_components([(s, int(p)) for s, p in zip(signed, prints.tolist(), strict=True)])
    assert [roots.get(s, s) for s in signed] == want


def test_components_of_a_long_path(spark):
    links = spark.range(1, 60).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    assert {r.root for r in components(links).collect()} == {0}
    assert components(links.limit(0)).count() == 0


# 9. Decontamination


def holds(text, item):
    flat = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    return bool(flat(item).strip()) and flat(item) in flat(text)


@pytest.mark.parametrize("max_item_bytes", [1 << 25, 4000])
def test_planted_items_are_found(spark, sf, given_docs, max_item_bytes):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.findings(docs, items, max_item_bytes=max_item_bytes).collect()}
    assert got == {(d, r.item_id) for r in items.collect() for d, t in given_docs if holds(t, r.text)}
    assert got


def test_scores_are_bm25(spark):
    items = [(1, "red green blue. The answer is yellow."), (2, "red apples grow. On old trees."), (3, ""), (4, None), (None, "the the the.")]
    df, n = {}, len(items)
    words = [decontaminate.words(t or "") for _, t in items]
    for own in words:
        for w in set(own):
            df[w] = df.get(w, 0) + 1
    mean = sum(map(len, words)) / n
    index = decontaminate.ItemIndex.built([(i, t or "") for i, t in items], df, n, mean, 0.3)
    text = "so red, green and yellow it is: the answer"
    got = {index.ids[i]: s for _, i, s, *_ in decontaminate._search(index, [text])}

    def weight(w, own):
        idf = np.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
        tf = own.count(w)
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own) / mean))

    for (i, _), own in zip(items, words, strict=True):
        whole = sum(weight(w, own) for w in set(own))
        score = sum(weight(w, own) for w in set(own) & set(decontaminate.words(text))) / whole if own else 0
        assert (i in got) == (score >= 0.3)
        if i in got:
            assert got[i] == pytest.approx(score)


def test_leaks_in_awkward_rows(spark, docs, rows, no_docs):
    items = spark.createDataFrame([(1, PROSE, "x"), (2, None, None), (3, "", "y"), (None, "one two", "z")], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.findings(docs, items).collect()}
    assert {d for d, i in got if i == 1} == {d for d, t in rows if holds(t, PROSE)} | {7}
    assert (11, None) in got
    kept = decontaminate.without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 10").count() == 1 and kept.where("doc_id = 4").count() == 0
    assert kept.where("doc_id IS NULL").count() == 1
    assert decontaminate.without_leaks(no_docs, items).count() == 0
    assert decontaminate.findings(docs, items.limit(0)).count() == 0


def test_questions_and_parts_of_items_leak(spark, sf, given_docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    items += [(9001, "Why so? Because the old grey mill stands by the slow river in the north."), (9002, "Who? Me.")]
    texts = []
    for i, text in items:
        question, answer = decontaminate.question_and_answer(text)
        cut = [p[: -(-6 * len(p) // 10)] for p in (question, answer)]
        texts += [" ".join(question), " ".join([*cut[0], "xx", *cut[1]]), " ".join(cut[1])]
        texts.append(" ".join([*question[: len(question) // 2 + 3], *["yy"] * 900, *question[len(question) // 2 - 3 :]]))
    long_items = [(i, t) for i, t in items if len(decontaminate.question_and_answer(t)[0]) >= 5]
    texts += ["why so and nothing else", "why so? " + items[-2][1].split("? ")[1], *(t for _, t in given_docs[:50])]

    def leaks(text, item):
        question, answer = decontaminate.question_and_answer(item)
        own = decontaminate.words(text or "")
        q, a = decontaminate.overlap(question, own), decontaminate.overlap(answer, own)
        return q >= 0.8 or (q >= 0.5 and a >= 0.5)

    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.findings(docs_of(spark, list(enumerate(texts))), table).collect()}
    want = {(d, i) for d, t in enumerate(texts) for i, item in long_items if leaks(t, item)}
    longs = {i for i, _ in long_items}
    assert {g for g in got if g[1] in longs} == want and len(want) > 2 * len(long_items) > 0
    # A very short question is a leak only with its answer.
    why = texts.index("why so and nothing else")
    assert (why, 9001) not in got and (why + 1, 9001) in got


# 10. Licenses


MIT = """Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
"""


def test_license_texts(spark, docs, rows, no_docs):
    texts = {
        1: ("prose without end\nLicensed under the Apache License, Version 2.0.\nmore", "Apache-2.0"),
        2: (MIT, "MIT"),
        3: (GPL, "GPL-3.0-or-later"),
        4: ("RELEASED UNDER THE MIT LICENSE.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", "MIT,CC-BY-NC-4.0"),
        5: ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ""),
        6: (MIT.replace("The above", "Something else. The above"), ""),
    }
    got = licenses.scan(docs_of(spark, [(i, t) for i, (t, _) in texts.items()])).collect()
    assert {r.doc_id: r.licenses for r in got} == {i: name for i, (_, name) in texts.items()}
    awkward_rows = licenses.scan(docs).collect()
    assert len(awkward_rows) == len(rows) and {r.licenses for r in awkward_rows} == {""}
    assert licenses.scan(no_docs).count() == 0


def test_every_rule_is_stated_by_known_sentences():
    names = {n for n, _ in licenses.SENTENCES}
    assert all(step in names for steps, _ in licenses.RULES for step in steps)
