"""Numpy helpers on Arrow batches of text, used inside Spark tasks.

Texts stay UTF-8 bytes in one buffer per chunk; words and n-grams become 64-bit codes without a
Python object per word.  Chunks hold whole texts up to about ``CHUNK`` bytes, so temporary arrays
stay small whatever the batch size; a longer text is a chunk of its own.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
U64 = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(9, 14)]] = True
_BYTE2 = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)
    offsets = raw[column.offset:column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if column.null_count:  # a null may own bytes
        lens = np.diff(offsets) * np.asarray(column.is_valid())
        if (lens != np.diff(offsets)).any():
            return text_buffer(column.fill_null(""))
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) over consecutive rows."""
    data, offsets = text_buffer(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    one = lambda b: np.concatenate([np.ones(1, U64), np.cumprod(np.full(n - 1, b & (2**64 - 1), U64))])
    return one(_BASE), one(inverse)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(CHUNK.bit_length(), int(n).bit_length())
    return _powers(size)


def word_codes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all words ``[^\\x20\\x09-\\x0D]+`` and, per text, where its words start.

    A word's code is a polynomial over random byte values taken from prefix sums, then mixed; two
    different words of a corpus of a billion share one with a chance of about 3 in 100 in all."""
    n = len(data)
    if n == 0:
        return np.empty(0, U64), np.zeros(len(offsets), np.int64)
    space = IS_SPACE[data]
    first = np.ones(n, bool)
    first[1:] = space[:-1]
    last = np.ones(n, bool)
    last[:-1] = space[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = True
    last[cut - 1] = True
    starts = np.flatnonzero(first & ~space)
    ends = np.flatnonzero(last & ~space) + 1
    up, down = powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[LOWERED[data] if lower else data] * up[:n], out=total[1:])
    codes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))
    return codes, np.searchsorted(starts, offsets)


def segment_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit codes of every piece ``data[start:end]``."""
    up, down = powers(len(data) + 1)
    out = []
    for table in (_BYTE, _BYTE2):
        total = np.zeros(len(data) + 1, U64)
        np.cumsum(table[data] * up[:len(data)], out=total[1:])
        out.append(mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64)))
    return out[0], out[1]


def padded(data: np.ndarray, offsets: np.ndarray, before: int, after: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``before`` pad bytes ahead and ``after`` behind each; the new offsets."""
    n = len(offsets) - 1
    at = offsets + np.arange(n + 1) * (before + after)
    out = np.full(int(at[-1]), pad, np.uint8)
    for i in range(n):
        a, b = offsets[i], offsets[i + 1]
        if b > a:
            out[at[i] + before:at[i] + before + b - a] = data[a:b]
    return out, at


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values[starts[i]:starts[i + 1]]; empty segments give 0."""
    total = np.concatenate([np.zeros(1, np.float64 if values.dtype.kind == "f" else np.int64), np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[starts[1:]] - total[starts[:-1]]


def segment_any_order_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Like ``segment_sums`` without the rounding of one long running sum."""
    out = np.zeros(len(starts) - 1)
    full = starts[1:] > starts[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, starts[:-1][full], dtype=np.float64)
    return out


class Counter:
    """Counts 64-bit codes in sorted arrays; ``drain`` hands them out."""

    def __init__(self, limit: int = 1 << 21):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.limit = 0, limit

    def add(self, codes: np.ndarray) -> None:
        if len(codes):
            seen, times = np.unique(codes, return_counts=True)
            self.parts.append((seen, times.astype(np.int32)))     # a task reads less than 2**31 codes
            self.size += len(seen)
            if self.size > self.limit:
                self.merge()

    def merge(self) -> None:
        codes = np.concatenate([p[0] for p in self.parts])
        counts = np.concatenate([p[1] for p in self.parts])
        self.parts = []
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.concatenate([np.ones(1, bool), codes[1:] != codes[:-1]]))
        self.parts = [(codes[first], np.add.reduceat(counts, first))]
        self.size = len(first)

    def full(self) -> bool:
        return self.size > self.limit // 2

    def drain(self) -> tuple[np.ndarray, np.ndarray] | None:
        if not self.parts:
            return None
        if len(self.parts) > 1:
            self.merge()
        got, self.parts, self.size = self.parts[0], [], 0
        return got
