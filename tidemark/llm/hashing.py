"""Vectorised 64-bit hashing of byte and word spans (numpy, inside tasks).

Rabin-Karp form: span [a, b) of a sequence v hashes to
``sum(v[i] * BASE**(i - a))`` modulo 2**64, taken from prefix sums and
finished by an avalanche step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 19  # how much text is hashed at once: bounds the working arrays, not the work


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche step, a bijection of 64-bit values (overwrites a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_values() -> np.ndarray:
    """One 64-bit value per byte value."""
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(BASE))


class Spans:
    """Hashes of any spans of one sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        powers = np.full(n, BASE, np.uint64)
        self.back = np.full(n + 1, INVERSE, np.uint64)
        if n:
            powers[0] = 1
            np.cumprod(powers, out=powers)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers, out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def fixed(self, size: int) -> np.ndarray:
        """Hashes of all spans of one size, without the avalanche step."""
        n = max(0, len(self.sums) - size)
        return (self.sums[size:size + n] - self.sums[:n]) * self.back[:n]


def chunks(docs: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive whole documents of about ``limit`` bytes, at least one document each."""
    lo, size = 0, 0
    for i, doc in enumerate(docs):
        if i > lo and size + len(doc) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(doc)
    if lo < len(docs):
        yield lo, len(docs)


class Words:
    """Words of some documents: maximal runs of bytes for which ``is_word`` holds.

    ``data`` holds the documents, a space after each; ``start``/``end``
    are byte offsets of the words in it, ``first`` the number of words
    before each document (one more entry than documents).
    """

    def __init__(self, docs: list[bytes], is_word: np.ndarray):
        self.data = np.frombuffer(b" ".join([*docs, b""]), np.uint8)
        inside = is_word[self.data]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.start, self.end = edge[0::2], edge[1::2]
        offsets = np.zeros(len(docs) + 1, np.int64)
        np.cumsum([len(d) + 1 for d in docs], out=offsets[1:])
        self.offsets = offsets
        self.first = np.searchsorted(self.start, offsets)

    def hashes(self) -> np.ndarray:
        return Spans(byte_values()[self.data]).hash(self.start, self.end)

    def windows(self, size: int) -> np.ndarray:
        """Word indices at which a window of ``size`` words of one document starts."""
        n = np.diff(self.first)
        room = np.maximum(n - size + 1, 0)
        return ranges(self.first[:-1], room)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (length[0] of them), start[1], ..."""
    length = np.asarray(length, np.int64)
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(length) - length
    return np.repeat(np.asarray(start, np.int64) - before, length) + np.arange(total)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the spans [start, end)."""
    if not len(start):
        return np.zeros(n, bool)
    return np.cumsum(np.bincount(start, minlength=n + 1)[:n] - np.bincount(end, minlength=n + 1)[:n]) > 0


def white_space() -> np.ndarray:
    """Byte table of space and tab to carriage return (20, 09-0D)."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table
