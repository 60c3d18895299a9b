"""Manifest, quality rules and phrases against plain versions, on awkward tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from runsift.llm import merkle, phrases, registered, weak_rules
from runsift.llm.common import table
from runsift.llm.rolling import Block

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, fp long, votes long, grp string"
PROSE = "The quick brown fox jumps over the lazy dog. Nobody looked at it, and the quick brown fox was gone"


def docs_of(spark, rows):
    """(doc_id, text, lang) rows, with columns whose names the operators use inside."""
    full = [(i, t, lang, None if i == 3 else "s", None if t is None else len(t), "x", 7, 1, None) for i, t, lang in rows]
    return spark.createDataFrame(full, DOCS)


def awkward():
    long_text = " ".join(f"Word{i % 97} and{i % 5}" + ("." if i % 11 == 0 else "") for i in range(20_000))
    rows = [
        (5, None, "en"),
        (3, "", "en"),
        (8, " \t\n ", None),
        (None, PROSE, None),
        (None, PROSE, None),
        (None, None, None),
        (1, PROSE, "en"),
        (2, PROSE.upper(), "en"),
        (4, PROSE + "!", "en"),
        (4, PROSE + "?", "en"),
        (4, PROSE + "!", "en"),
        (6, PROSE + "\n" + PROSE + "\n" + PROSE, "de"),
        (9, "Été ça et là 日本語; テスト, \U0001f600 ﬁn Été ça", "fr"),
        (10, "one", "und"),
        (12, long_text, "en"),
        (13, "a b " * 50, "de"),
        (14, "\r\n".join(["*** buy %%% now $$$"] * 30), "de"),
    ]
    return rows + [(100 + i, f"row {i} of many, the same words again and again", "es") for i in range(70)]


# -- manifest ----------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_tree(digests):
    """The last digest, and per leaf the (left, right) siblings from the leaf up."""
    ways, under = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(b, min(b + 8, len(digests))) for b in range(0, len(digests), 8)]
        for run in runs:
            for j in run:
                sides = ("".join(digests[k] for k in run if k < j), "".join(digests[k] for k in run if k > j))
                for leaf in under[j]:
                    ways[leaf].append(sides)
        under = [[leaf for j in run for leaf in under[j]] for run in runs]
        digests = [sha("".join(digests[j] for j in run)) for run in runs]
    return digests[0], ways


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        def leaf(text, r=r):
            return sha("".join(encoded(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))

        tampered = r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        seen = leaf(lowered(r.text)) if tampered else leaf(r.text)
        groups[r.lang].append(((r.doc_id is not None, r.doc_id or 0, leaf(r.text)), r.doc_id, seen))
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda x: x[0])
        trees[lang] = plain_tree([x[0][2] for x in groups[lang]])
    root, above = plain_tree([trees[lang][0] for lang in langs]) if langs else (None, [])
    out = []
    for lang, rest in zip(langs, above, strict=True):
        subroot, ways = trees[lang]
        for (key, doc_id, seen), way in zip(groups[lang], ways, strict=True):
            fold = seen
            for left, right in way + rest:
                fold = sha(left + fold + right)
            beside = "".join(left + right for left, right in way + rest)
            out.append((doc_id, key[2], subroot, root, sha(beside), fold, fold == root))
    return Counter(out)


@pytest.mark.parametrize("rows", [awkward(), awkward()[:1], awkward()[6:7], [], [(i, "x", None) for i in range(9)]])
def test_manifest(spark, rows):
    docs = docs_of(spark, rows)
    got = merkle.manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == plain_manifest(docs.collect())


def test_manifest_of_many_equal_rows(spark):
    rows = [(1, PROSE, "en")] * 300 + [(i, "x", "en") for i in range(20)]
    docs = docs_of(spark, rows)
    assert Counter(map(tuple, merkle.manifest(docs).collect())) == plain_manifest(docs.collect())


def test_manifest_of_many_groups(spark):
    docs = docs_of(spark, [(i, f"text {i}", f"l{i % 67}") for i in range(200)])
    assert Counter(map(tuple, merkle.manifest(docs).collect())) == plain_manifest(docs.collect())


# -- quality rules -----------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, len(inside)


def test_rule_counts(spark):
    docs = docs_of(spark, awkward())
    got = weak_rules.judged(docs).collect()
    wanted = []
    for r in docs.collect():
        counts = plain_counts(r.text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        wanted.append((r.doc_id, *counts, failed))
    assert Counter(tuple(r)[:7] for r in got) == Counter(wanted)
    assert not any(r.kept for r in got if r.base_failed)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \n#é", max_size=120))
def test_counts_of_any_text(text):
    assert tuple(weak_rules.measured(text)[0]) == plain_counts(text)


def plain_posteriors(patterns):
    """Expectation-maximisation document by document, with plain loops, over lists of votes -1, 0, 1."""
    rules, n = len(patterns[0]), len(patterns)
    prior = weak_rules.START_PRIOR
    good_share, bad_share = [weak_rules.ON_GOOD] * rules, [weak_rules.ON_BAD] * rules
    believed = weak_rules.BELIEF * n

    def posterior(votes):
        g, b = prior, 1 - prior
        for j, v in enumerate(votes):
            if v:
                g *= good_share[j] if v > 0 else 1 - good_share[j]
                b *= bad_share[j] if v > 0 else 1 - bad_share[j]
        return g / (g + b)

    for _ in range(weak_rules.STEPS):
        q = [posterior(votes) for votes in patterns]
        new = []
        for belief, weight in ((weak_rules.ON_GOOD, q), (weak_rules.ON_BAD, [1 - x for x in q])):
            shares = []
            for j in range(rules):
                up = sum(w for w, votes in zip(weight, patterns, strict=True) if votes[j] > 0)
                voted = sum(w for w, votes in zip(weight, patterns, strict=True) if votes[j])
                shares.append((up + believed * belief) / (voted + believed))
            new.append(shares)
        prior = (sum(q) + believed * weak_rules.START_PRIOR) / (n + believed)
        moved = max(abs(a - b) for a, b in zip(good_share + bad_share, new[0] + new[1], strict=True))
        good_share, bad_share = new
        if moved < 1e-12:
            break
    return [posterior(votes) for votes in patterns]


def test_rule_posteriors(spark, sf):
    docs = table(spark, sf, "documents")
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    measures = np.array([weak_rules.measured(text)[1] for _, text in texts])
    named = {name: measures[:, i] for i, name in enumerate(weak_rules.MEASURES)}
    votes = np.stack([rule.votes(named) for rule in weak_rules.RULES], axis=1)
    wanted = plain_posteriors(votes.tolist())
    got = {r.doc_id: r for r in registered.op12_quality_rules(spark, sf).collect()}
    assert len(got) == len(texts)
    for (doc_id, _), quality in zip(texts, wanted, strict=True):
        assert math.isclose(got[doc_id].quality, quality, abs_tol=2e-6)
        if abs(quality - 0.5) > 1e-4:
            assert got[doc_id].kept == (not got[doc_id].base_failed and quality >= 0.5)


def test_rules_against_labels(spark, sf):
    """No label is used; known good documents stay unless the base rule rejects them, poor ones go."""
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = [r for r in registered.op12_quality_rules(spark, sf).collect() if r.doc_id in labels]
    good = [r.kept for r in rows if labels[r.doc_id] == 1 and not r.base_failed]
    poor = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(poor) <= 0.05 * len(poor)


def test_one_rule_alone():
    """Votes of a single rule change with each limit, and a text without the measure is left alone."""
    rule = weak_rules.Rule("m", 0.2, 0.4, 0.1, 0.6, 5)
    values = np.array([0.3, 0.15, 0.1, 0.6, 0.5, np.nan, 0.3])
    words = np.array([5, 9, 9, 9, 9, 9, 4])
    assert rule.votes({"m": values, "words": words}).tolist() == [1, 0, -1, -1, 0, 0, 0]


def test_no_documents(spark):
    empty = docs_of(spark, [])
    assert weak_rules.judged(empty).count() == 0
    assert phrases.collocations(empty).count() == 0


# -- phrases -----------------------------------------------------------------------------------


def plain_words(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or ""))]


def plain_collocations(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r.lang is None else r.lang
        for words in plain_words(r.text):
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + k]
            for p, a in candidates.items()
            for k in range(2, len(p))
            for i in range(len(p) - k + 1)
            if 100 * a >= 80 * c[p[i : i + k]]
        }
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("bits,top", [(64, 2000), (64, 3), (10, 2000)])
def test_phrases(spark, bits, top):
    """With 10 bits nearly all fingerprints collide, and every count comes from the texts."""
    docs = docs_of(spark, awkward())
    got = phrases.collocations(docs, min_count=3, top=top, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_collocations(docs.collect(), 3, top)


def test_pruned_fingerprints_lose_nothing(spark, sf):
    docs = table(spark, sf, "documents")
    got = phrases.phrase_counts(docs, 4)
    wanted = Counter()
    for r in docs.select("lang", "text").collect():
        for words in plain_words(r.text):
            for k in range(1, 5):
                wanted.update((r.lang, k, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    assert {(r.lang, r.n, r.phrase): r.f for r in got.collect()} == {k: f for k, f in wanted.items() if f >= 4}


def test_batch_setting_stays(spark, sf):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    registered.op12_quality_rules(spark, sf)
    phrases.collocations(table(spark, sf, "documents"), 50)
    assert spark.conf.get(name) == before


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbé .,\t\n\x0b", max_size=40), min_size=1, max_size=5))
def test_block_words(texts):
    block = Block([t.encode() for t in texts], np.arange(len(texts)))
    wanted = [(i, w.encode()) for i, t in enumerate(texts) for piece in plain_words(t) for w in piece]
    spans = zip(block.text.tolist(), block.begins.tolist(), block.ends.tolist(), strict=True)
    assert [(t, block.data[b:e].tobytes()) for t, b, e in spans] == wanted
    pieces = [(i, " ".join(p[k : k + 2])) for i, t in enumerate(texts) for p in plain_words(t) for k in range(len(p) - 1)]
    at = block.windows(2)
    assert [(block.text[a], block.phrase(a, 2)) for a in at.tolist()] == pieces
    hashes = defaultdict(set)
    for key, value in zip(pieces, block.hashes(at, 2).tolist(), strict=True):
        hashes[key].add(value)
    assert all(len(v) == 1 for v in hashes.values()) and len(set.union(set(), *hashes.values())) == len(hashes)
