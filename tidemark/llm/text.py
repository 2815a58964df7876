"""Words of Arrow text columns as numpy arrays, and 64-bit hashes of byte spans.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``. All helpers work
on the UTF-8 bytes of a slice of rows at once; memory is about 50 bytes per
byte of text in the slice, so callers cut batches with :func:`slices`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RADIX = 0x9E3779B97F4A7C15
_INVERSE = pow(_RADIX, -1, 1 << 64)
RAW = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_RADIX))
LOWER = RAW.copy()
LOWER[65:91] = RAW[97:123]
_powers: list[np.ndarray] = []


def _radix_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        for k, base in enumerate((_RADIX, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k:k + 1] = [np.cumprod(steps, dtype=np.uint64)]
    return _powers[0], _powers[1]


#: Bytes from which a span is hashed by itself.
LONG_SPAN = 64


class SpanHash:
    """Hashes of any spans of one byte buffer, in constant time per span.

    The sums are polynomials modulo 2**64, in which long texts of two letters
    (Thue-Morse sequences) collide by construction. So spans above ``longest``
    bytes are hashed one by one with XXH3.
    """

    def __init__(self, data: np.ndarray, table: np.ndarray = RAW, longest: int = LONG_SPAN):
        self._data, self._lower, self._longest = data, table is LOWER, longest
        up, self._down = _radix_powers(len(data) + 1)
        self._sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * up[:len(data)], dtype=np.uint64, out=self._sum[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = mix((self._sum[ends] - self._sum[starts]) * self._down[starts])
        long = np.flatnonzero(ends - starts > self._longest)
        if len(long):
            text = self._data.tobytes()
            text = text.lower() if self._lower else text  # bytes: A-Z only
            out[long] = [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        return out

    def rolling(self, size: int) -> np.ndarray:
        """Hashes of all spans of ``size`` bytes, by start."""
        n = len(self._sum) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sum[size:] - self._sum[:n]) * self._down[:n])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column (null: empty) and the rows' offsets."""
    column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row at least)."""
    rows, i = len(offsets) - 1, 0
    while i < rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


class Words:
    """Word spans of a slice of rows: ``starts``, ``ends``, and ``doc`` (row index)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        self.data, self.offsets = data, offsets
        space = _SPACE[data]
        self.solid = ~space
        first, last = np.ones(n, bool), np.ones(n, bool)
        first[1:], last[:-1] = space[:-1], space[1:]
        first[offsets[:-1][offsets[:-1] < n]] = True
        last[(offsets[1:] - 1)[offsets[1:] > 0]] = True
        self.starts = np.flatnonzero(first & self.solid)
        self.ends = np.flatnonzero(last & self.solid) + 1
        self.counts = np.diff(np.searchsorted(self.starts, offsets))
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def hashes(self, table: np.ndarray = RAW) -> np.ndarray:
        return SpanHash(self.data, table)(self.starts, self.ends)


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive word hashes, by first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(_RADIX) + hashes[k:n + k]
    return mix(total)


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` (one per byte) for each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def members(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    at = np.searchsorted(of, values)
    at[at == len(of)] = 0
    return of[at] == values


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur more than once."""
    ordered = np.sort(keys)
    twice = distinct(ordered[1:][ordered[1:] == ordered[:-1]])
    flags = np.zeros(len(keys), bool)
    if len(twice):
        table = np.zeros(1 << 18, bool)
        table[(twice & np.uint64(0x3FFFF)).astype(np.int64)] = True
        near = np.flatnonzero(table[(keys & np.uint64(0x3FFFF)).astype(np.int64)])
        flags[near] = members(keys[near], twice)
    return flags
