"""Quality classifier by nearest-neighbour voting among labelled latent-semantic vectors.

Every whole text becomes a vector of three families of terms: hashed byte trigrams, trigrams of character kinds (capital,
small letter, digit, each mark for itself, ...) and how often words repeat their predecessors or earlier words. Shares are
square-rooted and weighted by inverse document frequency, counted over all documents; each family has length one. A
latent space is fitted by a randomised singular value decomposition on labelled documents, at most `MAX_LABELLED` of them
by smallest id hash: the classifier's documented, bounded sample. Their vectors are broadcast (`MAX_LABELLED` times
`DIMENSIONS` floats) and every document is compared with all of them by exact cosines, block by block. The `NEIGHBOURS`
most similar vote with their label, weighted by similarity, beside a weak vote for the share of good labels.

Labels are learnt by id and text; ids, languages and sources are no input of a score.

Defined cases: null and empty texts get the vote of the empty text's vector, or the share of good labels where nothing
is similar; without any usable label the score is 0.5; null labels are not learnt from; of several labels of an id the
largest counts, of several texts of a labelled id the one with the smallest hash; equal texts get equal scores; repeated
rows and null ids keep their rows; other columns, whatever their names, pass unchanged through `accepted`.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.common import batch_rows, free_names, text_or_empty

MAX_LABELLED = 4096
DIMENSIONS = 48
NEIGHBOURS = 15
PRIOR_WEIGHT = 0.1
ACCEPTED_FROM = 0.7
BYTE_TERMS, KIND_TERMS, REPEAT_TERMS = 2048, 1024, 16
TERMS = BYTE_TERMS + KIND_TERMS + REPEAT_TERMS
FAMILIES = (slice(0, BYTE_TERMS), slice(BYTE_TERMS, BYTE_TERMS + KIND_TERMS), slice(BYTE_TERMS + KIND_TERMS, TERMS))
# Texts in an Arrow batch, documents whose vectors a task holds at once, bytes of text it counts at once.
BATCH_ROWS, BLOCK_DOCS, BLOCK_BYTES = 1000, 256, 1 << 20


def _kinds() -> np.ndarray:
    """Kind of a byte: letters by case, digits, bytes beyond ASCII, white space, and each mark for itself."""
    kind = np.arange(256, dtype=np.uint32)
    for low, high, code in ((65, 90, 65), (97, 122, 97), (48, 57, 48), (128, 255, 97), (9, 13, 10)):
        kind[low : high + 1] = code
    return kind


KIND_OF = _kinds()


def _hash_counts(codes: np.ndarray, size: int) -> np.ndarray:
    """Counts of hashed trigrams of a sequence of codes."""
    if len(codes) < 3:
        return np.zeros(size)
    mixed = (codes[:-2] << np.uint32(16)) ^ (codes[1:-1] << np.uint32(8)) ^ codes[2:]
    mixed = (mixed * np.uint32(2654435761)) >> np.uint32(32 - int(math.log2(size)))
    return np.bincount(mixed, minlength=size)


def _repeat_counts(text: str) -> np.ndarray:
    """One of eight levels of the share of words equal to the word before, and one of the share seen before at all."""
    out = np.zeros(REPEAT_TERMS)
    words = text.split()
    if words:
        adjacent = sum(map(operator.eq, words, words[1:])) / len(words)
        earlier = 1 - len(set(words)) / len(words)
        out[min(7, math.ceil(adjacent * 20))] = 1
        out[8 + min(7, int(earlier * 8))] = 1
    return out


def term_counts(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    counts = np.zeros(TERMS)
    for begin in range(0, max(len(data) - 2, 0), BLOCK_BYTES):
        part = data[begin : begin + BLOCK_BYTES + 2]
        counts[FAMILIES[0]] += _hash_counts(part, BYTE_TERMS)
        counts[FAMILIES[1]] += _hash_counts(KIND_OF[part], KIND_TERMS)
    counts[FAMILIES[2]] = _repeat_counts(text)
    return counts


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted vectors of rows of counts, each family of length one (or zero, where it has no term)."""
    out = np.sqrt(counts) * idf
    for family in FAMILIES:
        length = np.linalg.norm(out[:, family], axis=1, keepdims=True)
        out[:, family] /= np.where(length > 0, length, 1)
    return out.astype(np.float32)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    mean: np.ndarray
    basis: np.ndarray
    labelled: np.ndarray
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        out = (vectors(counts, self.idf) - self.mean) @ self.basis
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(length > 0, length, 1)

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), 0.5)
        if not len(self.labels):
            return out
        prior = self.labels.mean()
        k = min(NEIGHBOURS, len(self.labels))
        for begin in range(0, len(texts), BLOCK_DOCS):
            block = np.stack([term_counts(t) for t in texts[begin : begin + BLOCK_DOCS]])
            cosines = self.latent(block) @ self.labelled.T
            nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(float) ** 2
            votes = (weight * self.labels[nearest]).sum(axis=1)
            out[begin : begin + len(block)] = (votes + PRIOR_WEIGHT * prior) / (weight.sum(axis=1) + PRIOR_WEIGHT)
        # Rounded, so that the block a text happens to be in does not show in its score.
        return np.round(np.clip(out, 0.0, 1.0), 6)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """log((1 + n) / (1 + documents with the term)) + 1 for every term, over all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, found = 0, np.zeros(TERMS, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                found += term_counts(text) > 0
                n += 1
        yield pa.RecordBatch.from_pydict({"term": pa.array(range(-1, TERMS)), "n": pa.array([n, *found.tolist()])})

    rows = docs.select(text_or_empty("text").alias("text")).mapInArrow(counted, "term long, n long")
    table = rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(TERMS + 1)
    counts[table["term"].to_numpy() + 1] = table["n"].to_numpy()
    return np.log((1 + counts[0]) / (1 + counts[1:])) + 1


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Counts and labels of a bounded number of labelled documents. `labels` has doc_id and quality."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # Some labels have no document.
    present = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    names = F.broadcast(chosen.select(F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("quality")))
    rows = docs.select("doc_id", text_or_empty("text").alias("text")).join(names, F.col("doc_id") == F.col("__id"))
    rows = rows.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    packed = F.pandas_udf(
        lambda texts: pd.Series([term_counts(t).astype(np.float32).tobytes() for t in texts]), "binary"
    )
    rows = rows.select("doc_id", "quality", packed("text").alias("counts"))
    table = rows.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    counts = [np.frombuffer(b, np.float32) for b in table["counts"].to_pylist()]
    return np.stack(counts) if counts else np.zeros((0, TERMS), np.float32), table["quality"].to_numpy()


def fitted(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """Model from documents and labels; the driver holds the sample and one number per term."""
    batch_rows(docs.sparkSession, BATCH_ROWS)
    idf = inverse_frequencies(docs)
    counts, quality = labelled_sample(docs, labels, limit)
    rows = vectors(counts, idf)
    mean = rows.mean(axis=0) if len(rows) else np.zeros(TERMS, np.float32)
    basis = _latent_basis(rows - mean, DIMENSIONS)
    model = Model(idf, mean, basis, np.zeros((0, basis.shape[1]), np.float32), np.asarray(quality, float))
    return Model(idf, mean, basis, model.latent(counts), model.labels)


def _latent_basis(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    dimensions = max(1, min(dimensions, *rows.shape))
    if not len(rows):
        return np.zeros((rows.shape[1], 1), np.float32)
    start = np.random.default_rng(7).standard_normal((rows.shape[1], dimensions + 8)).astype(np.float32)
    for _ in range(4):
        start, _ = np.linalg.qr(rows.T @ (rows @ start))
    small = rows @ start
    _, _, turn = np.linalg.svd(small, full_matrices=False)
    return np.ascontiguousarray((start @ turn.T)[:, :dimensions])


def score_column(docs: DataFrame, model: Model, text: Column) -> Column:
    """Score of every text: an Arrow-batched look at the broadcast model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.scores(texts.tolist()))

    return F.pandas_udf(scored, "double")(text)


def learnable(labels: DataFrame) -> DataFrame:
    """Labels that may be learnt from: all but the held-out quarter."""
    return labels.where(~is_held_out(F.col("doc_id")))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    model = fitted(docs, learnable(labels), limit)
    rows = docs.select("doc_id", score_column(docs, model, text_or_empty("text")).alias("score"))
    return rows.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPTED_FROM).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """The documents, with all columns, whose score says good."""
    model = fitted(docs.select("doc_id", "text"), learnable(labels), limit)
    (score,) = free_names(docs, "quality_score")
    rows = docs.withColumn(score, score_column(docs, model, text_or_empty("text")))
    return rows.where(F.col(score) >= ACCEPTED_FROM).select(*docs.columns)
