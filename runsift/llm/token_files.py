"""Token ids in files: one zstandard frame per document, a shared dictionary, an offset index.

Layout of a token folder, every part a Parquet table in the shared store:

| part | columns |
|---|---|
| `dictionary` | `hash` (sha256 of the dictionary), `dictionary` (bytes) |
| `blocks` | `shard`, `block`, `dictionary_hash`, `payload`: frames one after the other; `doc_ids`, `offsets`, `lengths`, `starts`, `counts` of the documents in them |
| `index` | `doc_id`, `shard`, `block`, `offset`, `length`, `start` (ids of the shard before it), `n_tokens`: where to find one short document |
| `shards` | `shard`, `start` (ids of all shards before it), `n_tokens` |

Shards are ranges of document ids in ascending order (null first, equal ids by text), one per write task. A frame holds
the width of an id in bytes and the ids, little endian, compressed with a dictionary trained on serialised id arrays of
a bounded sample: `SAMPLE_DOCS` distinct texts by smallest hash, `SAMPLE_CHARS` characters of each. The sample only tunes the
compression; all documents are written whole. Only the table of shards, one row per task, is held by every executor.

Defined cases: a null text is empty and has the end id only; repeated rows are written each; where the sample is too
small to train on, its raw bytes are the dictionary, and an empty table has an empty one; reading with another dictionary
than a block names is an error; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runsift.llm.common import batch_bytes, text_or_empty
from runsift.llm.tokens import BATCH_BYTES, END_ID, VOCABULARY, crc32_of, encoder, vocabulary_path
from runsift.session import written

SAMPLE_DOCS, SAMPLE_CHARS = 1000, 20_000
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
# Payload after which a block is closed; a longer document makes a longer block of its own.
BLOCK_BYTES = 1 << 20
# Blocks in an Arrow batch when they are read.
READ_BYTES = 4 << 20
BLOCKS_SCHEMA = (
    "shard int, block int, dictionary_hash string, payload binary, doc_ids array<long>, offsets array<long>, "
    "lengths array<long>, starts array<long>, counts array<long>"
)
_BLOCKS_ARROW = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("dictionary_hash", pa.string()), ("payload", pa.binary())]
    + [(n, pa.list_(pa.int64())) for n in ("doc_ids", "offsets", "lengths", "starts", "counts")]
)


def serialised(ids: np.ndarray) -> bytes:
    """Width in bytes, then the ids: two bytes each if all fit, else four."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def deserialised(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.uint32)


def trained_dictionary(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> bytes:
    """Dictionary of a bounded sample; the driver sees no more than the sample."""
    text = text_or_empty("text")
    order = F.xxhash64(text)
    # The bound is found among hashes, so that tasks send the driver numbers, and only the chosen texts follow.
    bound = docs.select(order.alias("h")).distinct().orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    chosen = docs.where(order <= bound).select(F.substring(text, 1, SAMPLE_CHARS).alias("text"), order.alias("h"))
    texts = [row.text for row in chosen.dropDuplicates(["h"]).orderBy("h").limit(SAMPLE_DOCS).collect()]
    samples = [serialised(ids) for ids in encoder(vocabulary_path(vocabulary)).ids(texts, end_id)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


@functools.lru_cache(maxsize=4)
def _codec(dictionary: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if known:
        known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known), zstandard.ZstdDecompressor(dict_data=known)


class _Block:
    """Documents of the block being filled."""

    def __init__(self, shard: int, name: str) -> None:
        self.shard, self.name, self.number, self.start = shard, name, 0, 0
        self.clear()

    def clear(self) -> None:
        self.frames: list[bytes] = []
        self.lists: dict[str, list] = {n: [] for n in ("doc_ids", "offsets", "lengths", "starts", "counts")}
        self.size = 0

    def add(self, doc_id: int | None, frame: bytes, count: int) -> None:
        for name, value in zip(self.lists, (doc_id, self.size, len(frame), self.start, count), strict=True):
            self.lists[name].append(value)
        self.frames.append(frame)
        self.size += len(frame)
        self.start += count

    def closed(self) -> pa.RecordBatch:
        row = {"shard": [self.shard], "block": [self.number], "dictionary_hash": [self.name]}
        row |= {"payload": [b"".join(self.frames)]} | {n: [v] for n, v in self.lists.items()}
        self.number += 1
        self.clear()
        return pa.RecordBatch.from_pydict(row, _BLOCKS_ARROW)


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Encode every text and write a token folder. One shuffle, of the texts, brings them into order."""
    spark = docs.sparkSession
    dictionary = trained_dictionary(docs, vocabulary, end_id)
    name = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(name, dictionary)], "hash string, dictionary binary").write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor, _ = _codec(shared.value)
        block = _Block(TaskContext.get().partitionId(), name)
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            for doc_id, own in zip(ids, encoder(vocabulary_path(vocabulary)).ids(batch["text"], end_id), strict=True):
                block.add(doc_id, compressor.compress(serialised(own)), len(own))
                if block.size >= BLOCK_BYTES:
                    yield block.closed()
        if block.frames:
            yield block.closed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    # One id may stand for any number of rows: their texts spread them.
    spread = F.xxhash64("text")
    rows = rows.repartitionByRange("doc_id", spread).sortWithinPartitions("doc_id", spread, "text")
    with batch_bytes(spark, BATCH_BYTES):
        rows.mapInArrow(blocks, BLOCKS_SCHEMA).write.option("compression", "none").parquet(f"{path}/blocks")
    stored = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/blocks")
    zipped = F.arrays_zip("doc_ids", "offsets", "lengths", "starts", "counts")
    index = stored.select("shard", "block", F.inline(zipped)).withColumnsRenamed(
        {"doc_ids": "doc_id", "offsets": "offset", "lengths": "length", "starts": "start", "counts": "n_tokens"}
    )
    index.write.parquet(f"{path}/index")
    index = spark.read.schema(index.schema).parquet(f"{path}/index")
    sizes = index.groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens")).orderBy("shard").collect()
    starts = np.cumsum([0] + [row.n_tokens for row in sizes]).tolist()
    rows = [(row.shard, start, row.n_tokens) for row, start in zip(sizes, starts, strict=False)]
    spark.createDataFrame(rows, "shard int, start long, n_tokens long").write.parquet(f"{path}/shards")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(row.dictionary).hexdigest() != row.hash:
        raise ValueError(f"the dictionary in {path} does not have the hash it is stored under")
    return row.hash, bytes(row.dictionary)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the blocks."""
    name, dictionary = _dictionary(spark, path)
    shared = spark.sparkContext.broadcast(dictionary)
    fields = [("shard", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]
    fields += [("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids
    schema = pa.schema(fields)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decompressor = _codec(shared.value)
        for batch in batches:
            for at in range(len(batch)):
                block = {field: batch[field][at] for field in batch.schema.names}
                if block["dictionary_hash"].as_py() != name:
                    raise ValueError(f"a block needs the dictionary {block['dictionary_hash']}, the folder has {name}")
                payload = memoryview(block["payload"].as_buffer())
                places = zip(block["offsets"].as_py(), block["lengths"].as_py(), strict=True)
                arrays = [deserialised(decompressor.decompress(payload[a : a + size])) for a, size in places]
                rows = {
                    "shard": [block["shard"].as_py()] * len(arrays),
                    "doc_id": block["doc_ids"].values,
                    "start": block["starts"].values,
                    "n_tokens": [len(a) for a in arrays],
                    "ids_crc32": [crc32_of(a) for a in arrays],
                }
                if with_ids:
                    rows["ids"] = [a.astype(np.int64) for a in arrays]
                yield pa.RecordBatch.from_pydict(rows, schema)

    kinds = "shard int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/blocks").mapInArrow(decoded, kinds)
    if not with_ids:
        # Digests are narrow; written here, their batches hold few blocks without the session's setting being changed.
        with batch_bytes(spark, READ_BYTES):
            rows = written(rows, "token-digests")
    shards = spark.read.parquet(f"{path}/shards").select("shard", F.col("start").alias("before"))
    rows = rows.join(F.broadcast(shards), "shard")
    return rows.select("doc_id", (F.col("start") + F.col("before")).alias("start"), *rows.columns[3:-1])


def read_documents(wanted: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of the documents whose ids `wanted` lists: by the index, decompressing their frames only."""
    spark = wanted.sparkSession
    _, dictionary = _dictionary(spark, path)
    shared = spark.sparkContext.broadcast(dictionary)
    places = spark.read.parquet(f"{path}/index").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    blocks = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{path}/blocks").select("shard", "block", "payload")
    frames = places.join(blocks, ["shard", "block"]).select(
        "doc_id", F.substring("payload", (F.col("offset") + 1).cast("int"), F.col("length").cast("int")).alias("frame")
    )

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decompressor = _codec(shared.value)
        for batch in batches:
            ids = [deserialised(decompressor.decompress(f)).astype(np.int64) for f in batch["frame"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "ids": pa.array(ids, pa.list_(pa.int64()))})

    return frames.mapInArrow(decoded, "doc_id long, ids array<long>")
