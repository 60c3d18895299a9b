"""Scores of documents whose asked postings stand together: each document is scored by itself."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsift.operators.queryterms import JOB, MUST, MUST_NOT, SHOULD
from runsift.schemas import KEY, SCORE_DECIMALS

# Postings that one task scores, and pairs of posting and query term that it holds at once (a document's are not parted).
TASK_POSTINGS = 250_000
STEP_PAIRS = 1 << 20

# What a query term is, beside the number of its word.
ASKED = ["qid", "n_must", "job_mode", "clause_no", "occur", "n_terms", "term_no"]


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """Equal values as equal numbers, null as a value of its own."""
    return column.combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _numbered(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, in order, and the number of each row among them."""
    rows, number = np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True)
    return rows, number.ravel()


def _groups(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


def _summed(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, in order, and the weight of each."""
    size = int(keys.max()) + 1
    if size <= 4 * len(keys):
        found = np.flatnonzero(np.bincount(keys, minlength=size))
        return found, np.bincount(keys, weight, size)[found]
    order = np.argsort(keys)
    first = _groups(keys[order])
    return keys[order][first], np.add.reduceat(weight[order], first)


@dataclass(frozen=True)
class AskedTerms:
    """A measured table of query terms as arrays. A slot is one term of a clause of a query; slots are numbered by
    clause, clauses by query, so what is sorted by slot is sorted by all of them."""

    words: np.ndarray
    begins: np.ndarray
    slots: np.ndarray
    clause_of: np.ndarray
    clauses: np.ndarray
    queries: np.ndarray
    qids: pa.Array

    @classmethod
    def of(cls, rows: pa.Table) -> AskedTerms:
        """From (ASKED, word): one row per query term and field, ``word`` a number for its word in that field."""
        qids = rows["qid"].combine_chunks().dictionary_encode("encode")
        n = {c: rows[c].to_numpy().astype(np.int64) for c in [*ASKED[1:], "word"]}
        queries, query = _numbered(qids.indices.to_numpy(zero_copy_only=False), n["n_must"], n["job_mode"])
        clauses, clause = _numbered(query, n["clause_no"], n["occur"], n["n_terms"])
        slots, slot = _numbered(clause, n["term_no"])
        order = np.argsort(n["word"], kind="stable")
        words, begins = np.unique(n["word"][order], return_index=True)
        by_query = qids.dictionary.take(pa.array(queries[:, 0]))
        return cls(words, np.append(begins, len(order)), slot[order], slots[:, 0], clauses, queries, by_query)

    def scored(self, rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Hits among whole documents; ``starts`` are the first rows of each."""
        weight = rows["weight"].to_numpy()
        begins = starts
        if "words" in rows.column_names:
            lists = rows["words"].combine_chunks()
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            asked, weight = lists.flatten().to_numpy(), np.repeat(weight, sizes)
            begins = (np.cumsum(sizes) - sizes)[starts]
        else:
            asked = rows["word"].to_numpy()
        word = np.searchsorted(self.words, asked)
        wide = self.begins[word + 1] - self.begins[word]
        before = np.cumsum(wide) - wide
        ends = np.append(begins[1:], len(word))
        cuts = np.append(_groups(before[begins] // STEP_PAIRS), len(begins))
        keys = rows.select(KEY)
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            own = slice(begins[low], ends[high - 1])
            document = np.repeat(np.arange(high - low), ends[low:high] - begins[low:high])
            doc, query, total = self._scored_step(document, word[own], weight[own], wide[own])
            found = keys.take(pa.array(starts[low + doc])).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    self.qids.take(pa.array(query)),
                    *[found[k].combine_chunks() for k in KEY],
                    pa.array(total),
                ],
                ["qid", *KEY, "total"],
            )

    def _scored_step(self, document, word, weight, wide):
        """(document, query, total) of the documents that satisfy a query."""
        skipped = np.repeat(self.begins[word] - np.cumsum(wide) + wide, wide)
        slot = self.slots[skipped + np.arange(len(skipped))]
        n_slots = len(self.clause_of)
        # The fields of a term.
        key, weight = _summed(np.repeat(document, wide) * n_slots + slot, np.repeat(weight, wide))
        doc, slot = np.divmod(key, n_slots)
        clause = self.clause_of[slot]
        # The terms of a clause: all of them must be there, which they are where none has more than one.
        if (self.clauses[:, 3] > 1).any():
            first = _groups(doc * len(self.clauses) + clause)
            found = np.diff(np.append(first, len(clause)))
            weight, doc, clause = np.add.reduceat(weight, first), doc[first], clause[first]
            whole = found == self.clauses[clause, 3]
            weight, doc, clause = weight[whole], doc[whole], clause[whole]
            if not len(clause):
                return doc, clause, weight
        # The clauses of a query.
        query, occur = self.clauses[clause, 0], self.clauses[clause, 2]
        first = _groups(doc * len(self.queries) + query)
        met = {kind: np.add.reduceat((occur == kind).astype(np.int64), first) for kind in (MUST, SHOULD, MUST_NOT, JOB)}
        total = np.add.reduceat(np.where(occur == MUST_NOT, 0.0, weight), first)
        doc, query = doc[first], query[first]
        n_must, job_mode = self.queries[query, 1], self.queries[query, 2]
        fits = (
            (met[MUST_NOT] == 0)
            & (met[MUST] == n_must)
            & ((n_must > 0) | (met[SHOULD] > 0))
            & ((met[JOB] == 1) | (job_mode == 0))
        )
        return doc[fits], query[fits], total[fits]


def _starts(rows: pa.Table) -> np.ndarray:
    changed = np.zeros(rows.num_rows, bool)
    changed[:1] = True
    for k in KEY:
        code = _codes(rows[k])
        changed[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(changed)


def score_slices(postings: DataFrame, asked: DataFrame, n_postings: int) -> DataFrame:
    """(qid, project, number, score): documents that satisfy their query, with the BM25 sum.

    ``postings`` (project, number, word, weight) are those of asked words, about ``n_postings`` of them; they are spread
    by document over as many tasks as their number takes, and no posting is paired with its query terms before a task
    has the document's in hand. A posting may stand for several words, then listed in a column ``words``. ``asked``
    (ASKED, word) was measured and may be broadcast.
    """
    terms = asked.sparkSession.sparkContext.broadcast(AskedTerms.of(asked.toArrow()))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
            starts = _starts(rows)
            # The last document may go on in the next batch.
            if len(starts) > 1:
                yield from terms.value.scored(rows.slice(0, starts[-1]), starts[:-1])
            rest = rows.slice(starts[-1])
        if rest is not None:
            yield from terms.value.scored(rest, np.zeros(1, np.int64))

    kinds = dict(postings.dtypes) | dict(asked.dtypes)
    together = postings.repartition(max(1, math.ceil(n_postings / TASK_POSTINGS)), *KEY)
    found = together.sortWithinPartitions("number", "project").mapInArrow(
        scored, ", ".join(f"{c} {kinds[c]}" for c in ["qid", *KEY]) + ", total double"
    )
    return found.select("qid", *KEY, F.round("total", SCORE_DECIMALS).alias("score"))
