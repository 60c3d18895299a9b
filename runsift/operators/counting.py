"""Tokens of whole documents counted where the documents stand, run by run."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from runsift.operators.scoring import _groups, _starts
from runsift.schemas import KEY

# Tokens of a run of documents that are counted together, and at once (a larger document is counted words by words).
RUN_TOKENS = 1_000_000
STEP_TOKENS = 2_000_000
# Rows of a batch that leaves.
_OUT_ROWS = 1 << 16


def _encoded(rows: pa.Table) -> tuple[pa.Table, np.ndarray, pa.Array, np.ndarray | None]:
    """Rows without their tokens, the number of tokens of each, the tokens as numbers of distinct words, their parts."""
    lists = rows["found"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    parts = rows["parts"].combine_chunks().flatten().to_numpy() if "parts" in rows.column_names else None
    return rows.select([*KEY, "field", "n_tokens", "base"]), sizes, lists.flatten().dictionary_encode(), parts


def _steps(codes: np.ndarray) -> Iterator[np.ndarray]:
    """The places of all tokens; of very many, word by word, so that only a part is sorted at once."""
    if len(codes) <= STEP_TOKENS:
        yield np.arange(len(codes))
        return
    step_of = np.cumsum(np.bincount(codes)) // STEP_TOKENS
    for step in np.unique(step_of):
        found = np.flatnonzero(step_of[codes] == step)
        if len(found):
            yield found


def _counted_run(run: list[tuple], places: bool) -> Iterator[pa.RecordBatch]:
    """Counts of the encoded rows of a run; if these have the parts of their words, by part, word and field."""
    rows = pa.concat_tables([r for r, _, _, _ in run]).combine_chunks()
    sizes = np.concatenate([s for _, s, _, _ in run])
    words = pa.chunked_array([w for _, _, w, _ in run]).unify_dictionaries()
    terms = words.chunk(0).dictionary
    codes = np.concatenate([w.indices.to_numpy(zero_copy_only=False) for w in words.chunks])
    row_of, begins = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), np.cumsum(sizes) - sizes
    field = rows["field"].combine_chunks().dictionary_encode()
    document = np.zeros(len(sizes), np.int64)
    document[_starts(rows)[1:]] = 1
    text = np.cumsum(document) * len(field.dictionary) + field.indices.to_numpy(zero_copy_only=False)
    base, n_tokens = rows["base"].to_numpy(), rows["n_tokens"].to_numpy()
    names = rows.select([*KEY, "field"])
    by_part = run[0][3] is not None
    if by_part:
        part = np.zeros(len(terms), np.int64)
        part[codes] = np.concatenate([p for _, _, _, p in run])
        place = np.empty(len(terms), np.int64)
        place[pc.array_sort_indices(terms).to_numpy()] = np.arange(len(terms))
        place += part * len(terms)
        name = np.empty(len(field.dictionary), np.int64)
        name[pc.array_sort_indices(field.dictionary).to_numpy()] = np.arange(len(name))
        name = name[field.indices.to_numpy(zero_copy_only=False)]
    for at in _steps(codes):
        row, code = row_of[at], codes[at]
        key = text[row] * len(terms) + code
        pos = base[row] + at - begins[row]
        order = np.argsort(key, kind="stable")
        first = _groups(key[order])
        falls = pos[order][1:] < pos[order][:-1]
        falls[first[1:] - 1] = False
        if falls.any():
            # Documents that share a key.
            order = np.lexsort((pos, key))
        ends = np.append(first[1:], len(order))
        row, code, pos = row[order], code[order], pos[order]
        dl = np.maximum.reduceat(n_tokens[row], first)
        if by_part:
            out = np.argsort(place[code[first]] * len(field.dictionary) + name[row[first]], kind="stable")
            first, ends, dl = first[out], ends[out], dl[out]
        for low in range(0, len(first), _OUT_ROWS):
            own = slice(low, low + _OUT_ROWS)
            lead, last = first[own], ends[own]
            found = names.take(pa.array(row[lead])).combine_chunks()
            columns = [found[c].combine_chunks() for c in names.column_names]
            columns += [terms.take(pa.array(code[lead])), pa.array(last - lead), pa.array(dl[own])]
            if places:
                size = last - lead
                offsets = np.append(0, np.cumsum(size))
                inside = np.arange(offsets[-1]) + np.repeat(lead - offsets[:-1], size)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(pos[inside])))
            yield pa.RecordBatch.from_arrays(columns, [*names.column_names, "term", "tf", "dl", "pos"][: len(columns)])


def count_tokens(lists: DataFrame, places: bool = True) -> DataFrame:
    """(project, number, field, term, tf, dl, pos) from short lists of tokens (project, number, field, n_tokens, base,
    found); ``base`` is the place of a list's first token. A document's lists stand together in one task. Without
    ``places`` there is no column of them. With a column ``parts``, a number for each token's word, the rows of a run of
    documents come in the order of part, word and field.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, n, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            starts = _starts(rows)
            goes_on = last == [rows[k][0].as_py() for k in KEY]
            last = [rows[k][-1].as_py() for k in KEY]
            here = _encoded(rows)
            n += len(here[2])
            cut = int(starts[-1])
            if n >= RUN_TOKENS and (cut or not goes_on):
                # The last document may go on in the next batch.
                if cut:
                    run.append(_encoded(rows.slice(0, cut)))
                    here = _encoded(rows.slice(cut))
                if run:
                    yield from _counted_run(run, places)
                run, n = [], len(here[2])
            run.append(here)
        if run:
            yield from _counted_run(run, places)

    kinds = dict(lists.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*KEY, "field"]) + ", term string, tf bigint, dl bigint"
    return lists.mapInArrow(counted, schema + (", pos array<bigint>" if places else ""))
