"""SimHash document fingerprints and their search by permuted block tables.

A fingerprint has 128 bits in two longs. Its terms are the pairs of neighbouring words of the whole text (a single word
alone if there is no pair); a term's weight is its number of occurrences times a weight that grows with its length, as
pairs of short function words say little. Every term votes with its weight on each bit of its two 64-bit hashes, for or
against; the sign of the sum is the bit. A text without words has the zero fingerprint. Equal texts have equal ones.

Votes are counted as sums of packed counters in one aggregation, so no row per bit exists. The search cuts fingerprints
into radius + 1 blocks; two fingerprints within the radius agree in one block at least, so a table per block, keyed by
that block, holds every neighbour. Equal fingerprints are one entry there.

Defined cases: a null text is empty; documents go by id, descending, null ids last, and by text hash within an id;
equal rows (same id and text) stand next to each other; a table of one row is its own next document; other columns are
not read; empty tables give no row. Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runsift.llm.common import ascii_lower, ascii_words, hex16, shingle_rows, text_or_empty, vote_sums, voted_bits
from runsift.session import written

BITS = 128
TERM_WORDS = 2
WORDS_64 = ("fp_high", "fp_low")


def fingerprinted(df: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """`key` columns (which tell rows apart), fp_high, fp_low of the texts."""
    rows = shingle_rows(df.select(*key, text), ascii_words(ascii_lower(text_or_empty(text))), TERM_WORDS)
    rows = rows.drop(text)
    first, second = F.col("__w1"), F.col("__w2")
    some = F.col("__p").isNotNull()
    weight = F.when(some, 1 + F.least(F.length(F.concat_ws("", first, second)) / F.lit(4), F.lit(7.0)).cast("long"))
    high = F.xxhash64(F.lit(1), first, second)
    low = F.xxhash64(F.lit(2), first, second)
    rows = rows.select(*key, weight.alias("__weight"), high.alias("__high"), low.alias("__low"))
    votes = rows.groupBy(*key).agg(
        F.sum("__weight").alias("__total"),
        *vote_sums(F.col("__high"), "__h", F.col("__weight")),
        *vote_sums(F.col("__low"), "__l", F.col("__weight")),
    )
    total = F.coalesce("__total", F.lit(0).cast("long"))
    return votes.select(*key, voted_bits("__h", total).alias("fp_high"), voted_bits("__l", total).alias("fp_low"))


def shown(high: Column | str, low: Column | str) -> Column:
    return F.concat(*[hex16(F.col(half) if isinstance(half, str) else half) for half in (high, low)])


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Cosine of the weighted term vectors as the share of differing bits estimates it; 0 where it is negative."""
    return F.greatest(F.lit(0.0), F.cos(distance(a, b) * F.lit(math.pi / BITS)))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """(q_high, q_low, fp_high, fp_low, bits): for every distinct query fingerprint all distinct ones within the radius.

    Both tables hold fp_high, fp_low. Block tables are joined by block number and value; every match is verified.
    """
    blocks = radius + 1
    if not 0 <= radius < 64:
        raise ValueError("radius is from 0 to 63")
    edges = [BITS * j // blocks for j in range(blocks + 1)]

    def block(begin: int, end: int) -> Column:
        # Bits begin..end of the 128, as the hash of the masked halves.
        masks = []
        for half in range(2):
            mask = sum(1 << bit for bit in range(64) if begin <= 64 * half + bit < end)
            masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
        return F.struct(
            F.col("fp_high").bitwiseAND(F.lit(masks[0]).cast("long")).alias("h"),
            F.col("fp_low").bitwiseAND(F.lit(masks[1]).cast("long")).alias("l"),
        )

    def tables(df: DataFrame) -> DataFrame:
        values = [
            F.struct(F.lit(j).alias("table"), block(edges[j], edges[j + 1]).alias("value")) for j in range(blocks)
        ]
        rows = df.select(*WORDS_64).distinct().select(*WORDS_64, F.explode(F.array(*values)).alias("b"))
        return rows.select(*WORDS_64, "b.table", "b.value.*")

    wanted = tables(queries).withColumnsRenamed({"fp_high": "q_high", "fp_low": "q_low"})
    pairs = wanted.join(tables(prints), ["table", "h", "l"])
    bits = distance((F.col("q_high"), F.col("q_low")), (F.col("fp_high"), F.col("fp_low")))
    return pairs.select("q_high", "q_low", *WORDS_64, bits.alias("bits")).where(F.col("bits") <= radius).distinct()


NO_ID = -(2**63)


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, key, tie, text): key and tie name a row's id and text and are never null, so one partitioning serves all."""
    text = text_or_empty("text")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select("doc_id", key.alias("key"), F.xxhash64(text, F.col("doc_id").isNull()).alias("tie"), text.alias("text"))


def document_order(docs: DataFrame) -> DataFrame:
    """(doc_id, key, tie, n_chars, copies, next_key, next_tie): documents descending by id, each with its successor.

    Only ids, hashes and lengths are sorted. Ranges are sorted apart; a range's last document finds its successor in a
    table with one row per range.
    """
    narrow = _named(docs).groupBy("key", "tie").agg(
        F.max("doc_id").alias("doc_id"), F.max(F.length("text")).alias("n_chars"), F.count("*").alias("copies")
    )
    order = [F.col("key").desc(), F.col("tie")]
    ranges = written(narrow.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "document-ranges")
    inside = Window.partitionBy("range").orderBy(*order)
    follower = F.struct("key", "tie")
    rows = ranges.withColumns({"follower": F.lead(follower).over(inside), "place": F.row_number().over(inside)})
    firsts = rows.where("place = 1").select("range", follower.alias("first"))
    across = Window.orderBy("range")
    everywhere = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select(
        "range", F.coalesce(F.lead("first").over(across), F.first("first").over(everywhere)).alias("beyond")
    )
    rows = rows.join(F.broadcast(firsts), "range")
    after = F.coalesce("follower", "beyond")
    return rows.select(
        "doc_id", "key", "tie", "n_chars", "copies", after["key"].alias("next_key"), after["tie"].alias("next_tie")
    )


def edited_texts(docs: DataFrame, order: DataFrame) -> DataFrame:
    """(doc_id, key, tie, copy, copies, text, edited): the last third of each text gives way to the next text's beginning.

    The texts are shuffled once by document; of the next document only the characters that are needed travel.
    """
    equal = Window.partitionBy("key", "tie").orderBy("tie")
    # Both uses of the texts below need the same columns, so that they share one shuffle.
    own = _named(docs).select("key", "tie", "text").withColumns(
        {"copy": F.row_number().over(equal), "first": F.lag(F.lit(1)).over(equal).isNull()}
    )
    wanted = order.select(
        F.col("next_key").alias("key"),
        F.col("next_tie").alias("tie"),
        F.col("key").alias("for_key"),
        F.col("tie").alias("for_tie"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("need"),
        "doc_id",
        "copies",
    )
    begins = own.where("first").join(wanted, ["key", "tie"]).select(
        F.col("for_key").alias("key"),
        F.col("for_tie").alias("tie"),
        "doc_id",
        "copies",
        "need",
        F.substring("text", F.lit(1), F.col("need")).alias("begin"),
    )
    rows = own.join(begins, ["key", "tie"])
    kept = F.substring("text", F.lit(1), F.length("text") - F.col("need"))
    following = F.when(
        F.col("copy") < F.col("copies"), F.substring("text", F.lit(1), F.col("need"))
    ).otherwise(F.col("begin"))
    return rows.select("doc_id", "key", "tie", "copy", "copies", "text", F.concat(kept, following).alias("edited"))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: text and edited text fingerprinted, and how near its neighbours are.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    """
    order = written(document_order(docs), "document-order")
    texts = edited_texts(docs, order)
    key = ["doc_id", "key", "tie", "copy", "copies", "n_chars", "edited_sha256"]
    both = texts.select(
        *key[:5],
        F.length("text").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.posexplode(F.array("text", "edited")).alias("version", "text"),
    )
    prints = fingerprinted(both, [*key, "version"])
    pair = F.struct(*WORDS_64)
    rows = prints.groupBy(*key).agg(
        F.max(F.when(F.col("version") == 0, pair)).alias("own"), F.max(F.when(F.col("version") == 1, pair)).alias("edited")
    )
    rows = written(rows, "fingerprints")
    firsts = rows.where("copy = 1").select(
        F.col("key").alias("next_key"), F.col("tie").alias("next_tie"), F.col("own").alias("next")
    )
    successors = order.join(firsts, ["next_key", "next_tie"]).select("key", "tie", "next")
    rows = rows.join(successors, ["key", "tie"])
    following = F.when(F.col("copy") < F.col("copies"), F.col("own")).otherwise(F.col("next"))
    halves = lambda c: (c["fp_high"], c["fp_low"])
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        shown(F.col("own.fp_high"), F.col("own.fp_low")).alias("fingerprint"),
        shown(F.col("edited.fp_high"), F.col("edited.fp_low")).alias("edited_fingerprint"),
        likeness(halves(F.col("own")), halves(F.col("edited"))).alias("near_edited"),
        likeness(halves(F.col("own")), halves(following)).alias("near_next"),
    )
