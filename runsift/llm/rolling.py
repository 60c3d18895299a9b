"""Words and n-gram fingerprints of many texts at once, by numpy prefix polynomials.

Texts stand one after the other in one array of bytes. Prefix sums of byte times power give the polynomial of any stretch
in one subtraction, so every word has its hash without a loop; prefix sums over word hashes give every n-gram's the same
way. Arithmetic is modulo 2^64 with odd bases, whose powers have inverses; a finishing step mixes the high bits into the
low ones.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np

_ONE = np.uint64(1)
# Bases of the byte and the word polynomials: two independent pairs. Any odd numbers do.
BASES = ((0x9E3779B97F4A7C15, 0xD1342543DE82EF95), (0xC2B2AE3D27D4EB4F, 0xF1357AEA2E62A9C5))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
# Bytes of words whose prefix sums are held at once.
SLICE_BYTES = 1 << 17
SPACES = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"
_WORD, _SPACE, _BREAK = 0, 1, 2


def _table() -> np.ndarray:
    kinds = np.full(256, _WORD, np.uint8)
    kinds[list(SPACES)] = _SPACE
    kinds[list(BREAKS)] = _BREAK
    return kinds


KIND = _table()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits under which every bit depends on all."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


@functools.lru_cache(maxsize=8)
def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = _ONE
    return np.cumprod(out, dtype=np.uint64)


def powers(base: int, count: int) -> np.ndarray:
    """The first powers, kept in sizes that double."""
    return _powers(base, 1 << max(count - 1, 1).bit_length())[:count]


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    """sums[j] - sums[i] is the polynomial of values i to j - 1, times base^i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), dtype=np.uint64, out=out[1:])
    return out


def stretch(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    inverse = pow(base, -1, 1 << 64)
    return (sums[ends] - sums[begins]) * powers(inverse, len(sums))[begins]


class Block:
    """The words of some texts: where they are, their piece, their text and their place in it."""

    def __init__(self, texts: list[bytes], seeds: np.ndarray) -> None:
        self.data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        kind = KIND[self.data]
        inside = np.zeros(len(kind) + 1, np.int8)
        np.equal(kind, _WORD, out=inside[1:].view(bool))
        steps = np.diff(inside)
        # The data ends in a break, so every word has an end.
        self.begins, self.ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        self.piece = np.cumsum(kind == _BREAK, dtype=np.int32)[self.begins]
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
        self.first_word = np.searchsorted(self.begins, starts)
        counts = np.diff(np.append(self.first_word, len(self.begins)))
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.seeds = np.asarray(seeds, np.uint64)

    @functools.cached_property
    def word_no(self) -> np.ndarray:
        """A word's place in its text."""
        return np.arange(len(self.begins)) - self.first_word[self.text]

    def _word_hashes(self, base: int) -> np.ndarray:
        """A hash per word, from the polynomials of stretches of whole words: sums take eight times the bytes they are of."""
        out = np.zeros(len(self.begins), np.uint64)
        edges = np.flatnonzero(np.diff(self.begins // SLICE_BYTES, prepend=-1))
        for first, last in itertools.pairwise([*edges.tolist(), len(out)]):
            start = self.begins[first]
            sums = prefix_sums(self.data[start : self.ends[last - 1]].astype(np.uint64) + _ONE, base)
            out[first:last] = stretch(sums, self.begins[first:last] - start, self.ends[first:last] - start, base)
        return mixed(out)

    @functools.cached_property
    def _sums(self) -> list[np.ndarray]:
        return [prefix_sums(self._word_hashes(of_bytes), of_words) for of_bytes, of_words in BASES]

    def windows(self, n: int) -> np.ndarray:
        """First words of all n-grams: n words within one piece."""
        last = len(self.begins) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1 :])

    def hashes(self, at: np.ndarray, n: int, which: int = 0) -> np.ndarray:
        """64-bit hashes of the n-grams at some words; texts with other seeds have other hashes."""
        base = BASES[which][1]
        return mixed(stretch(self._sums[which], at, at + n, base) ^ self.seeds[self.text[at]] ^ np.uint64(n))

    def phrase(self, at: int, n: int) -> str:
        """The words of an n-gram with one blank between them."""
        spans = zip(self.begins[at : at + n].tolist(), self.ends[at : at + n].tolist(), strict=True)
        return b" ".join(self.data[b:e].tobytes() for b, e in spans).decode("utf-8", "replace")
