"""Token ids of whole texts, encoded once per distinct word.

The vocabulary drops white space between words, so a text's ids are those of its space-separated chunks in order. Each
distinct chunk goes through the tokenizers library once per task; the ids of a text are then gathered by index.
"""

from __future__ import annotations

import ctypes
import functools
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
# Distinct chunks a worker remembers, and bytes of their letters, before it forgets those that one batch used.
MEMO_CHUNKS, MEMO_BYTES = 600_000, 16 << 20
# New chunks that go through the tokenizer together.
LEARN_CHUNKS = 1 << 14
# Bytes of text in an Arrow batch, and those whose distinct chunks are looked up together.
BATCH_BYTES = 1 << 22
# ASCII marks that may end a chunk; a run of them is a token group of its own.
TAIL_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Byte-level vocabularies show the printable Latin-1 bytes as themselves and the others, in order, from U+0100 on.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LETTERS = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def _pieces_of(chunk: str) -> tuple[str, ...]:
    """A word and the marks after it are encoded apart, as the vocabulary splits them itself."""
    if chunk.isascii() and chunk.isalpha():
        return (chunk.lower(),)
    stem = chunk.rstrip(TAIL_MARKS)
    if not _is_latin_word(stem):
        return (chunk,)
    word = stem.lower()
    return (word, chunk[len(stem) :]) if len(stem) < len(chunk) else (word,)


def _is_latin_word(piece: str) -> bool:
    """Only letters below U+0250 but for the one whose lower case is two characters: normalised by lower() alone."""
    return piece.isalpha() and (piece.isascii() or (max(piece) < "\u0250" and "\u0130" not in piece))


class TextEncoder:
    """ids(texts) equals the tokenizer's own encoding of every text, without special tokens around it."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._model = self._tokenizer.model
        self._start()

    def _start(self) -> None:
        # Chunks by number, as Arrow strings: a Python object for each would take twenty times the memory.
        self._known = pa.array([], pa.large_string())
        self._flat = np.empty(1 << 18, np.uint32)
        # Where a chunk's ids begin, and in how many batches it was seen.
        self._starts = np.zeros(1 << 16, np.int64)
        self._uses = np.zeros(1 << 16, np.uint32)

    def _forget(self) -> None:
        """Keep chunks of several batches, at most the newer half of the memory."""
        known, uses = self._known, self._uses[: len(self._known)]
        kept = np.flatnonzero(uses > 1)[-(len(known) // 2) :]
        uses, flat, sizes = uses[kept], *self._gathered(kept)
        self._start()
        self._add(known.take(pa.array(kept)), flat, sizes)
        self._uses[: len(kept)] = np.maximum(uses // 2, 1)

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some chunks one after the other, and how many each has."""
        begins = self._starts[numbers]
        sizes = self._starts[numbers + 1] - begins
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.arange(total) + np.repeat(begins - ends + sizes, sizes)], sizes

    def _add(self, chunks: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Number new chunks in order; their ids go behind those known. Arrays grow where they are."""
        known = len(self._known)
        first, total = int(self._starts[known]), known + len(chunks)
        if total >= len(self._starts):
            for values in (self._starts, self._uses):
                values.resize(total + total // 4 + 1, refcheck=False)
        if first + len(flat) > len(self._flat):
            self._flat.resize((first + len(flat)) * 5 // 4, refcheck=False)
        self._flat[first : first + len(flat)] = flat
        self._starts[known + 1 : total + 1] = first + np.cumsum(sizes)
        self._known = pa.concat_arrays([self._known, chunks])

    def _learn(self, new: pa.Array) -> None:
        """Give new chunks numbers, in order, and store their ids behind those known."""
        chunks = new.to_pylist()
        split = [_pieces_of(chunk) for chunk in chunks]
        # Words with different marks behind them share their pieces; those are kept for this batch only.
        pieces: dict[str, bytes] = {}
        other = []
        for piece in {piece for parts in split for piece in parts}:
            if _is_latin_word(piece):
                shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_LETTERS)
                pieces[piece] = array("I", [token.id for token in self._model.tokenize(shown)]).tobytes()
            else:
                other.append(piece)
        for piece, encoding in zip(
            other, self._tokenizer.encode_batch(other, add_special_tokens=False), strict=True
        ):
            pieces[piece] = array("I", encoding.ids).tobytes()
        found = [pieces[parts[0]] if len(parts) == 1 else pieces[parts[0]] + pieces[parts[1]] for parts in split]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        self._add(new, np.frombuffer(b"".join(found), np.uint32), sizes)

    def _numbers(self, distinct: pa.Array) -> np.ndarray:
        found = pc.index_in(distinct, value_set=self._known)
        numbers = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(numbers < 0)
        numbers[new] = len(self._known) + np.arange(len(new))
        for begin in range(0, len(new), LEARN_CHUNKS):
            self._learn(distinct.take(pa.array(new[begin : begin + LEARN_CHUNKS])))
        self._uses[numbers] += 1
        return numbers

    def ids(self, texts: pa.Array | list[str | None], end_id: int | None = END_ID) -> Iterator[np.ndarray]:
        """One uint32 array per text (null: empty), with the end id appended unless it is None."""
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // BATCH_BYTES
        edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)] if len(texts) else []
        for begin, end in zip(edges, edges[1:], strict=False):
            yield from self._batch(texts.slice(begin, end - begin), end_id)
        give_back()

    def _batch(self, texts: pa.Array, end_id: int | None) -> Iterator[np.ndarray]:
        chunks = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = pc.dictionary_encode(chunks.flatten())
        numbers = self._numbers(coded.dictionary.cast(pa.large_string()))[coded.indices.to_numpy()]
        # Per text: its chunks' ids one after the other, copied by index.
        edges = chunks.offsets.to_numpy() - chunks.offsets[0].as_py()
        for begin, end in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            found, _ = self._gathered(numbers[begin:end])
            ids = np.empty(len(found) + (end_id is not None), np.uint32)
            ids[: len(found)] = found
            if end_id is not None:
                ids[-1] = end_id
            yield ids
        if len(self._known) > MEMO_CHUNKS or self._known.nbytes > MEMO_BYTES:
            self._forget()


def give_back() -> None:
    """Return freed memory to the system where the C library can; a worker lives on after its task, beside others."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> TextEncoder:
    """One encoder per worker process and vocabulary file; Arrow's freed memory goes back to the system there."""
    pa.set_memory_pool(pa.system_memory_pool())
    return TextEncoder(vocabulary)


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where this process finds a public vocabulary; each worker asks for itself."""
    import public_tokenizers

    return public_tokenizers.path(name)


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
