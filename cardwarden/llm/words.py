"""Words of whole columns of text as 64-bit hashes, computed in numpy on Arrow's buffers.

A word is a longest run of the bytes of a class. Every class used here holds either all or
none of the bytes above 0x7F, so a run of bytes is also a run of code points. Hashes have 64
bits: two different words or shingles of one corpus share a hash with a probability of about
(number of words)^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Everything but white space: [^\x20\x09-\x0D].
SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
#: Letters, digits and every character above ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F], once lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True
#: Letters and every character above ASCII.
LETTER = ALNUM.copy()
LETTER[0x30:0x3A] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_PRIME = 0x9E3779B97F4A7C15 & ~7 | 5
_RANDOM = np.random.default_rng(20_240_101)
#: A random number for each byte, whose low byte is the byte itself, so that no two agree.
_CODES = (_RANDOM.integers(0, 1 << 56, 256, dtype=np.uint64) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
_CODES = _CODES[_LOWER]


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were needed so far; sent to a task without them."""

    def __init__(self):
        self.rows = [np.ones(0, np.uint64)] * 2

    def __reduce__(self):
        return _Powers, ()

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.rows[0]) < n:
            m = 1 << max(12, (n - 1).bit_length())
            for k, base in enumerate((_PRIME, pow(_PRIME, -1, 1 << 64))):
                row = np.full(m, base, np.uint64)
                row[0] = 1
                self.rows[k] = np.cumprod(row)
        return self.rows[0][:n], self.rows[1][:n]


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64 (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bucket(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    """Number below 2^bits for each hash; another spread for each salt."""
    return ((h + np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)).astype(np.int64)


def runs(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of rows over the stretches that begin at each ``at`` and end at the next; 0 for an empty stretch."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[at[1:]] - total[at[:-1]]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without null values, and where each value starts and the last ends."""
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class ByteHashes:
    """Hashes of any spans of some bytes, ASCII letters lower-cased, from one running sum."""

    def __init__(self, data: np.ndarray):
        powers, self.inverses = _POWERS.first(len(data))
        self.total = np.empty(len(data) + 1, np.uint64)
        self.total[0] = 0
        np.cumsum(_CODES[data] * powers, out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans from each start to before its end; every span must hold a byte."""
        return mix((self.total[end] - self.total[start]) * self.inverses[start])


class Words:
    """Words of a column: first byte, byte after the last, hash, and where each text's words start.

    The words of text i are those from ``at[i]`` to ``at[i + 1]``.
    """

    def __init__(self, column: pa.Array, kind: np.ndarray):
        self.data, self.offsets = buffers(column)
        self.start, self.end = spans(self.data, self.offsets, kind)
        self.at = np.searchsorted(self.start, self.offsets)
        self.hashes = ByteHashes(self.data)
        self.hash = self.hashes.of(self.start, self.end)

    def text_of(self) -> np.ndarray:
        """Number of each word's text."""
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def affixes(self, words: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
        """Hashes of the first k bytes of the given words for each k above 0, of the last -k bytes below 0."""
        start, end = self.start[words], self.end[words]
        out = []
        for k in lengths:
            a, b = (start, np.minimum(start + k, end)) if k > 0 else (np.maximum(end + k, start), end)
            out.append(self.hashes.of(a, b) + np.uint64(k % 64))
        return out


def spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes of a class; none goes over the border of two texts."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = kind[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words of one text; of the whole text where it has fewer; none of no words."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    n = min(n, len(words))
    count = len(words) - n + 1
    out = np.full(count, n, np.uint64)
    for k in range(n):
        out = out * np.uint64(_PRIME) + words[k : k + count]
    return mix(out)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``most`` bytes of text, one row at least, so that memory is bounded."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = np.array([0 if x is None else x for x in pa.compute.binary_length(batch.column(column)).to_pylist()], np.int64)
        piece = (np.cumsum(lengths) - 1).clip(0) // most
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)


def filled(column: pa.Array) -> pa.Array:
    """The column with empty texts for null."""
    return pa.compute.fill_null(column.cast(pa.large_string()), "")
