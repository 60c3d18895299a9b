"""Phrase collocations by Rabin-Karp fingerprints: which words stand together more often than apart.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words at blanks and tabs. Per
language every phrase of 1 to 4 words is counted, overlaps included:

- Numpy prefix polynomials give every n-gram of a block of texts its 64-bit fingerprint (`rolling`); the language is part
  of it. Each block adds up its own fingerprints before anything is shuffled, so a hot phrase is one row per block.
- The shuffle adds up fingerprints of one length after the other. A row holds the count, the smallest occurrence pointer
  (hash of the text, number of the word in it) and the sum of a second, independent hash of all occurrences. A phrase can
  only be frequent if the phrases without its last and without its first word are, so from two words on only those
  n-grams are counted; which were frequent is told by a bitmap of bounded size, whose errors only let more n-grams pass.
- Only frequent fingerprints are materialised: their pointers lead to some texts, and the phrase is read there.
- Against that text each is verified: the fingerprint must be the pointer's own, and the sum over all occurrences must be
  the count times the second hash of the text. Where it is not, unequal phrases share a fingerprint, and those
  occurrences are counted anew by their texts.

Candidates have 2 to 4 words and at least `MIN_COUNT` occurrences; see `scored` and `kept` for cuts and nested phrases.
All arithmetic on counts is on decimals and exact.

Defined cases: null and empty texts hold no words; a null language is `und`; repeated rows count as often as they stand;
ties follow the stated order; an empty table gives no rows; other columns are ignored, whatever their names. Counts go up
to 2^43 per phrase, words up to 2^32 per text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsift.llm.common import batch_bytes, text_or_empty
from runsift.llm.rolling import Block
from runsift.llm.tokens import give_back
from runsift.session import broadcast_if_small, written

MAX_WORDS = 4
MIN_COUNT = 30
NESTED_PERCENT = 80
SCORE_SCALE = 2_000_000
TOP = 2000
UNKNOWN_LANG = "und"
# Bytes of text a task hashes at once (one text at least), and of an Arrow batch.
BLOCK_BYTES = 1 << 21
# Bits of the second hash: their sum over all occurrences stays within 63 bits.
CHECK_BITS = 20
# Bits of the bitmap of frequent fingerprints: so many for each, within these powers of two.
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 16, 28
# Parts into which a language is dealt before its best phrases are chosen.
TOP_PARTS = 64
_WORD_RUN = r"[^\x20\x09.,;:!?\x0A-\x0D]+"


def prepared(docs: DataFrame) -> DataFrame:
    """(text, lang, seed, text_hash)"""
    rows = docs.select(text_or_empty("text").alias("text"), F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"))
    return rows.select("text", "lang", F.xxhash64("lang").alias("seed"), F.hash("text").alias("text_hash"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch]]:
    """Batches in blocks of about BLOCK_BYTES; a longer text is a block of its own."""
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        at = np.cumsum([len(t) for t in texts]) // BLOCK_BYTES
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(texts)] if texts else []
        seeds = batch["seed"].to_numpy().view(np.uint64)
        for begin, end in zip(edges, edges[1:], strict=False):
            yield Block(texts[begin:end], seeds[begin:end]), batch.slice(begin, end - begin)
        give_back()


def _among(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set; the leading bits of a hash are the bit's number."""
    number = hashes >> np.uint64(64 - (len(bitmap) * 64).bit_length() + 1)
    return (bitmap[number >> np.uint64(6)] >> (number & np.uint64(63))) & np.uint64(1) == 1


def _prints(block: Block, at: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Fingerprints of n-grams; tests that want collisions have them with fewer bits."""
    hashes = block.hashes(at, n)
    return hashes if bits == 64 else hashes & ~np.uint64((1 << (64 - bits)) - 1)


def _kept_windows(block: Block, n: int, shorter: np.ndarray | None, bits: int) -> np.ndarray:
    """First words of the n-grams whose two (n-1)-grams may be frequent."""
    at = block.windows(n)
    if shorter is None or not len(at):
        return at
    at = at[_among(shorter, _prints(block, at, n - 1, bits))]
    return at[_among(shorter, _prints(block, at + 1, n - 1, bits))]


def _checks(block: Block, at: np.ndarray, n: int) -> np.ndarray:
    return (block.hashes(at, n, 1) >> np.uint64(64 - CHECK_BITS)).astype(np.int64)


def _counter(n: int, shorter: Broadcast | None, bits: int) -> Callable:
    """Per block one row per fingerprint: occurrences, smallest pointer, sum of the occurrences' second hashes."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            at = _kept_windows(block, n, None if shorter is None else shorter.value, bits)
            if not len(at):
                continue
            prints = _prints(block, at, n, bits)
            order = np.argsort(prints)
            prints, at = prints[order], at[order]
            first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
            owner = rows["text_hash"].to_numpy().astype(np.int64)[block.text[at]]
            pointers = (owner << 32) | block.word_no[at]
            yield pa.RecordBatch.from_pydict(
                {
                    "fp": prints[first].view(np.int64),
                    "f": np.diff(np.append(first, len(prints))),
                    "pointer": np.minimum.reduceat(pointers, first),
                    "checks": np.add.reduceat(_checks(block, at, n), first),
                }
            )

    return counted


def frequent(rows: DataFrame, n: int, shorter: Broadcast | None, min_count: int, bits: int) -> DataFrame:
    """(n, fp, f, pointer, checks) of the n-grams with at least `min_count` occurrences."""
    found = rows.mapInArrow(_counter(n, shorter, bits), "fp long, f long, pointer long, checks long")
    summed = found.groupBy("fp").agg(
        F.sum("f").alias("f"), F.min("pointer").alias("pointer"), F.sum("checks").alias("checks")
    )
    return written(summed.where(F.col("f") >= min_count).select(F.lit(n).alias("n"), "*"), f"phrases-{n}")


def bitmap_of(prints: DataFrame, column: str = "fp") -> np.ndarray:
    """A bit for each fingerprint, of which there are `BITS_EACH` times as many; never more than 2^MOST_BITS bits.

    Tasks join bits to words of 64, so at most 2^MOST_BITS / 64 rows of two numbers come to the driver. With more
    fingerprints than that the bitmap lets more n-grams pass and the answer stays.
    """
    wanted = math.ceil(math.log2(BITS_EACH * max(prints.count(), 1)))
    size = min(max(wanted, LEAST_BITS), MOST_BITS)
    number = F.shiftrightunsigned(column, 64 - size)
    words = (
        prints.select(number.alias("number"))
        .select(
            F.shiftright("number", 6).alias("word"),
            F.expr("shiftleft(1L, cast(number & 63 AS int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (size - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def _reader(bits: int) -> Callable:
    """Reads the phrase at each pointer of a text, if the fingerprint there is the pointer's own."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("lang", "n", "fp", "phrase", "f", "sure")}
            seeds = batch["seed"].to_numpy().view(np.uint64)
            for i, (text, lang, wanted) in enumerate(
                zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), batch["wanted"].to_pylist(), strict=True)
            ):
                block = Block([text.encode("utf-8", "surrogatepass")], seeds[i : i + 1])
                for n in range(1, MAX_WORDS + 1):
                    there = set(block.windows(n).tolist())
                    mine = [w for w in wanted if w["n"] == n and w["at"] in there]
                    at = np.array([w["at"] for w in mine], np.int64)
                    if not len(at):
                        continue
                    prints = _prints(block, at, n, bits).view(np.int64).tolist()
                    for w, fp, check in zip(mine, prints, _checks(block, at, n).tolist(), strict=True):
                        if fp == w["fp"]:
                            out["lang"].append(lang)
                            out["n"].append(n)
                            out["fp"].append(fp)
                            out["phrase"].append(block.phrase(w["at"], n))
                            out["f"].append(w["f"])
                            out["sure"].append(check * w["f"] == w["checks"])
            yield pa.RecordBatch.from_pydict(out, schema=_READ)

    return read


_READ = pa.schema(
    [("lang", pa.string()), ("n", pa.int32()), ("fp", pa.int64()), ("phrase", pa.string()), ("f", pa.int64()),
     ("sure", pa.bool_())]
)


def materialised(rows: DataFrame, prints: DataFrame, bits: int) -> DataFrame:
    """(lang, n, fp, phrase, f, sure): the text of each frequent fingerprint, read where its pointer leads.

    Pointers of one text are as many as its n-grams at most. Copies of a text are read once.
    """
    to = prints.select(
        F.shiftright("pointer", 32).cast("int").alias("text_hash"),
        F.struct("n", "fp", F.col("pointer").bitwiseAND(F.lit(0xFFFFFFFF)).alias("at"), "f", "checks").alias("w"),
    )
    pointers = written(to.groupBy("text_hash").agg(F.collect_list("w").alias("wanted")), "phrase-pointers")
    texts = rows.join(broadcast_if_small(pointers.select("text_hash"), stored=True), "text_hash", "left_semi").distinct()
    found = texts.join(pointers, "text_hash").select("text", "lang", "seed", "wanted")
    schema = "lang string, n int, fp long, phrase string, f long, sure boolean"
    return written(found.mapInArrow(_reader(bits), schema).dropDuplicates(["n", "fp"]), "phrase-texts")


def recounted(rows: DataFrame, doubtful: DataFrame, min_count: int, bits: int) -> DataFrame:
    """(lang, n, phrase, f) of the n-grams under some fingerprints, counted by their texts."""
    bitmap = rows.sparkSession.sparkContext.broadcast(bitmap_of(doubtful))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, own in _blocks(batches):
            langs, found = own["lang"].to_pylist(), Counter()
            for n in range(1, MAX_WORDS + 1):
                at = block.windows(n)
                at = at[_among(bitmap.value, _prints(block, at, n, bits))]
                found.update((langs[t], n, block.phrase(w, n)) for t, w in zip(block.text[at].tolist(), at.tolist()))
            keys = list(found)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([k[0] for k in keys], pa.string()),
                    "n": pa.array([k[1] for k in keys], pa.int32()),
                    "phrase": pa.array([k[2] for k in keys], pa.string()),
                    "f": pa.array([found[k] for k in keys], pa.int64()),
                }
            )

    found = rows.mapInArrow(counted, "lang string, n int, phrase string, f long")
    return found.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, bits: int = 64) -> DataFrame:
    """(lang, n, phrase, f): all phrases of 1 to 4 words with at least `min_count` occurrences, counted exactly."""
    spark, rows = docs.sparkSession, prepared(docs)
    with batch_bytes(spark, BLOCK_BYTES):
        found, shorter = [], None
        for n in range(1, MAX_WORDS + 1):
            found.append(frequent(rows, n, shorter, min_count, bits))
            if shorter is not None:
                shorter.destroy()
            shorter = spark.sparkContext.broadcast(bitmap_of(found[-1]))
        texts = materialised(rows, reduce(DataFrame.unionByName, found), bits)
        counts = texts.where("sure").select("lang", "n", "phrase", "f")
        doubtful = texts.where("NOT sure")
        if not doubtful.isEmpty():
            again = recounted(rows, doubtful, min_count, bits).join(counts, ["lang", "phrase"], "left_anti")
            counts = counts.unionByName(again.select("lang", "n", "phrase", "f"))
        return written(counts, "phrase-counts")


def language_sizes(docs: DataFrame) -> DataFrame:
    """(lang, total): words per language."""
    rows = prepared(docs).groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(_WORD_RUN))).alias("total"))
    return rows.where("total > 0")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, n, phrase, a, l, r, score): candidates with their weakest cut.

    Cut after k words, a phrase scores floor(2000000 a / (l + r)) with the counts of its two parts; the smallest score
    over all cuts holds, the earliest cut in a tie.
    """
    words = F.split("phrase", " ")
    cuts = (
        counts.where("n >= 2")
        .select("lang", "n", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
        .select(
            "lang", "n", "phrase", "a", "k",
            F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
            F.array_join(F.slice("w", F.col("k") + 1, F.col("n") - F.col("k")), " ").alias("rest"),
        )
    )
    parts = counts.where(F.col("n") < MAX_WORDS)
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr(f"CAST(a AS DECIMAL(28,0)) * {SCORE_SCALE} div (CAST(l AS DECIMAL(28,0)) + r)")
    weakest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c")
    return cuts.groupBy("lang", "n", "phrase", "a").agg(weakest).select(
        "lang", "n", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score")
    )


def nested(counts: DataFrame) -> DataFrame:
    """(lang, phrase, most): the count of the most frequent longer candidate that holds a phrase."""
    words = F.split("phrase", " ")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("n") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("n") - size + 1), lambda at: F.array_join(F.slice(words, at, size), " ")
            ),
        )
    )
    held = counts.where("n > 2").select("lang", "f", F.explode(spans).alias("phrase"))
    return held.groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def best_of_each(rows: DataFrame, top: int) -> DataFrame:
    """Add rank, 1 to `top` within lang. A language is dealt into parts, of which only the best meet in one task."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    first = Window.partitionBy("lang", "part").orderBy(*order)
    few = rows.withColumn("part", part).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    return few.drop("part").withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases.

    A candidate goes if a longer one that holds its words occurs at least 80 % as often.
    """
    counts = phrase_counts(docs, min_count, bits)
    near = F.col("most").cast("decimal(28,0)") * 100 >= F.col("a").cast("decimal(28,0)") * NESTED_PERCENT
    rows = scored(counts).join(nested(counts), ["lang", "phrase"], "left")
    rows = rows.where(~F.coalesce(near, F.lit(False)))
    return (
        best_of_each(rows, top)
        .join(language_sizes(docs), "lang")
        .select(
            "lang",
            F.col("rank").cast("long").alias("rank"),
            "phrase",
            "a",
            "l",
            "r",
            F.col("total").cast("long").alias("n"),
            "score",
        )
    )
