"""URL filters by Bloom filter cascade.

A list of rules (host and path) is encoded in a chain of Bloom filters. The first holds the listed keys; the second holds
the corpus's keys that pass the first without being listed; the third the listed keys that pass the second; and so on
until no key is wrong. A key's answer is where the chain first says no, and it is exact for every listed key and every
key of the corpus the cascade was built over (its complete key universe). Judging reads the filters only: no join.

A URL's keys are all host suffixes (the host and its parent domains) with all path prefixes as long as some rule's path.
The key found with the most characters wins; a URL with no listed key gets the default verdict.

The filters are built by Spark aggregation over hashed bit positions. Only non-zero words of them reach the driver; their
size follows from the counted keys and is checked against `max_bytes`. A longer list is split by key hash into shards
that fit, each judged in a pass of its own over the pages.

Defined cases: a null URL or one without `://` has an empty host and path, no key and the default verdict; repeated rows
stay repeated; a key listed as both block and allow is an error; empty rule or page tables work; other columns of the
pages are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.common import ascii_lower, text_or_empty
from runsift.session import written

MAX_BYTES = 32 * 1024 * 1024
FIRST_RATE, LATER_RATE = 2.0**-10, 0.5
MAX_LEVELS = 64
# Bits by which each further level turns the hashes; odd, so that no two levels turn alike.
LEVEL_TURN = 11
ACTIONS = ("block", "allow")


def _turned(h: np.ndarray, turn: int) -> np.ndarray:
    bits = h.view(np.uint64)
    return ((bits << np.uint64(turn)) | (bits >> np.uint64(64 - turn))).view(np.int64) if turn else h


@dataclass(frozen=True)
class Level:
    """A Bloom filter. Each level turns the two hashes by its own number of bits, so that levels err independently."""

    bits: int
    hashes: int
    turn: int
    words: np.ndarray

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        h1, h2 = _turned(h1, self.turn), _turned(h2, self.turn)
        start, step = np.mod(h1, self.bits), np.mod(h2, self.bits - 1) + 1
        ok = np.ones(len(h1), bool)
        for i in range(self.hashes):
            at = np.mod(start + i * step, self.bits)
            ok &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return ok


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Exact membership of keys of the universe: the parity of the first level that a key does not pass."""
        listed = np.full(len(h1), len(self.levels) % 2 == 1)
        alive = np.arange(len(h1))
        for depth, level in enumerate(self.levels):
            ok = level.passes(h1[alive], h2[alive])
            listed[alive[~ok]] = depth % 2 == 1
            alive = alive[ok]
        return listed


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def url_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Keys under which a rule could list the URL, longest first."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    lengths = F.filter(F.lit(path_lengths).cast("array<int>"), lambda n: n <= F.length(path))
    keys = F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(
                lengths,
                lambda n: F.struct((F.length(s) + n).alias("size"), F.concat(s, F.substring(path, F.lit(1), n)).alias("key")),
            ),
        )
    )
    found = F.sort_array(F.filter(keys, lambda k: ~k["key"].startswith("/") & (k["key"] != "")), asc=False)
    return F.transform(found, lambda k: k["key"])


def _hashed(keys: DataFrame) -> DataFrame:
    return keys.select("key", F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    """Keys that pass a level, tested in Arrow batches against the broadcast words."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = shared.value.passes(batch["h1"].to_numpy(), batch["h2"].to_numpy())
            yield batch.filter(pa.array(ok))

    return keys.mapInArrow(test, keys.schema)


def _level(keys: DataFrame, rate: float, depth: int, max_bytes: int) -> Level:
    """A Bloom filter of the given keys; Spark sets the bits word by word."""
    n = keys.count()
    hashes = max(1, round(-math.log2(rate)))
    bits = 64 * max(2, math.ceil(max(n, 1) * hashes / math.log(2) / 64))
    if bits / 8 > max_bytes:
        raise ValueError(f"a filter of {bits // 8} bytes is over the limit of {max_bytes}; use more shards")
    steps = F.lit(list(range(hashes))).cast("array<long>")
    turn = depth * LEVEL_TURN % 64

    def turned(name: str) -> Column:
        return F.shiftleft(name, turn).bitwiseOR(F.shiftrightunsigned(name, 64 - turn)) if turn else F.col(name)

    start, step = F.pmod(turned("h1"), F.lit(bits)), F.pmod(turned("h2"), F.lit(bits - 1)) + 1
    at = keys.select(F.explode(F.transform(steps, lambda i: F.pmod(start + i * step, F.lit(bits)))).alias("at"))
    set_words = at.groupBy(F.floor(F.col("at") / 64).cast("long").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("value")
    )
    words = np.zeros(bits // 64, np.uint64)
    table = set_words.toArrow()
    words[table["word"].to_numpy()] = table["value"].to_numpy().view(np.uint64)
    return Level(bits, hashes, turn, words)


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """Cascade over `key` columns: `listed` keys are members, all other keys of `universe` are not.

    The universe is read once, by a map; what passes the first level is what later levels work on.
    """
    inside = written(_hashed(listed.select("key").distinct()), "listed-keys")
    levels = [_level(inside, FIRST_RATE, 0, max_bytes)]
    passed = _passing(_hashed(universe.select("key")), levels[0]).distinct()
    sides = passed.withColumn("own", F.lit(0)).union(inside.withColumn("own", F.lit(1)))
    wrong = sides.groupBy("key", "h1", "h2").agg(F.max("own").alias("own")).where("own = 0").drop("own")
    wrong = written(wrong, "false-positives")
    while not wrong.isEmpty():
        if len(levels) >= MAX_LEVELS:
            raise ValueError("two different keys have the same 128-bit hash")
        levels.append(_level(wrong, LATER_RATE, len(levels), max_bytes))
        inside, wrong = wrong, written(_passing(inside, levels[-1]), "false-positives")
    return Cascade(tuple(levels))


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), key), F.lit(shards)).cast("int")


def _judge_pass(pages: DataFrame, cascades: dict[str, Cascade], shard: int) -> DataFrame:
    """Fill `found` (place among the keys) and `action` with the first listed key, looking at one shard's keys."""
    shared = pages.sparkSession.sparkContext.broadcast(cascades)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("hashes"))
            sizes = np.diff(keys.offsets.to_numpy())
            flat = keys.flatten()
            h1, h2 = flat.field("h1").to_numpy(), flat.field("h2").to_numpy()
            here = np.flatnonzero(flat.field("shard").to_numpy() == shard)
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            found = batch["found"].to_numpy().copy()
            action = batch["action"].to_numpy().copy()
            for code, name in enumerate(ACTIONS):
                hit = here[shared.value[name].contains(h1[here], h2[here])]
                rows, first = np.unique(row[hit], return_index=True)
                better = place[hit][first] < found[rows]
                found[rows[better]], action[rows[better]] = place[hit][first][better], code
            columns = {
                **{n: batch[n] for n in batch.schema.names},
                "found": pa.array(found, pa.int64()),
                "action": pa.array(action, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns, batch.schema)

    return pages.mapInArrow(judge, pages.schema)


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = "allow", max_bytes: int = MAX_BYTES
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page; `rules` has (action, host, path), action block or allow."""
    listed = rules.select(
        "action", F.concat(ascii_lower(F.col("host")), F.col("path")).alias("key"), F.length("path").alias("size")
    )
    listed = written(listed.where(F.col("host") != "").distinct(), "url-rules")
    if not listed.groupBy("key").agg(F.countDistinct("action").alias("n")).where("n > 1").isEmpty():
        raise ValueError("a rule is listed both as block and as allow")
    facts = listed.agg(F.count("*"), F.collect_set("size")).first()
    path_lengths = sorted(facts[1])
    per_key = 1.5 * -math.log2(FIRST_RATE) / 8
    shards = max(1, math.ceil(facts[0] * per_key * 2 / max_bytes))
    url = text_or_empty("url")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    keys = url_keys(F.col("host"), F.col("path"), path_lengths)
    keyed = parts.withColumn("keys", keys)
    universe = keyed.select(F.explode("keys").alias("key"))
    hashes = F.transform(
        "keys",
        lambda k: F.struct(
            F.xxhash64(F.lit(1), k).alias("h1"), F.xxhash64(F.lit(2), k).alias("h2"), _shard(k, shards).alias("shard")
        ),
    )
    none = F.lit(2**31).cast("long")
    judged = keyed.withColumns({"hashes": hashes, "found": none, "action": F.lit(-1).cast("long")})
    for shard in range(shards):
        cascades = {
            action: build_cascade(
                listed.where((F.col("action") == action) & (_shard(F.col("key"), shards) == shard)),
                universe.where(_shard(F.col("key"), shards) == shard),
                max_bytes,
            )
            for action in ACTIONS
        }
        if shard:
            judged = written(judged, "judged-pages")
        judged = _judge_pass(judged, cascades, shard)
    rule = F.try_element_at("keys", (F.col("found") + 1).cast("int"))
    names = F.lit(list(ACTIONS))
    verdict = F.when(F.col("action") < 0, default).otherwise(F.get(names, F.col("action").cast("int")))
    rule = F.when(F.col("action") >= 0, rule)
    return judged.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
