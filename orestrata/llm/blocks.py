"""Text of Arrow batches as numpy arrays: words, their hashes, shingles, all without a loop over words.

Word hashes are 64-bit polynomials over random byte values, taken from running sums, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PAGE = 1 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True

_random = np.random.default_rng(20_240_607)
_BYTES = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, PAGE + 64)
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        if n > PAGE + 64:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not wide and not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null may have bytes below it
        gone = column.is_null().to_numpy(zero_copy_only=False)
        if (np.diff(offsets)[gone] > 0).any():
            return bytes_of(pa.array(["" if x is None else x for x in column.to_pylist()], pa.large_string()))
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ranges(offsets: np.ndarray, limit: int = PAGE, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes and `rows` rows, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(lo + 1, hi), lo + rows, n)
        yield lo, hi
        lo = hi


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per row the n + 1 offsets into them. `offsets` begin at 0."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = solid[edges]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edges = offsets[1:][offsets[1:] > 0] - 1
    last[edges] = solid[edges]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span; spans are in order and don't overlap. Memory is bounded by page or word."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + PAGE, "right")))
        page = data[base : ends[j - 1]]
        up, down = powers(len(page) + 1)
        total = np.zeros(len(page) + 1, np.uint64)
        np.cumsum(_BYTES[page] * up[: len(page)], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mixed((total[e] - total[s]) * down[s])
        i = j
    return out


def shingles(words: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within a row, and their rows; a shorter row is one run."""
    counts = np.diff(offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(offsets[1:], counts) - np.arange(len(words))  # words from here to the end of the row
    keep = left >= n
    short = (counts > 0) & (counts < n)
    keep[offsets[:-1][short]] = True
    at = np.flatnonzero(keep)
    total = np.zeros(len(at), np.uint64)
    for k in range(n):
        ok = left[at] > k
        total[ok] += words[at[ok] + k] * FACTORS[k]
    return mixed(total), row[at]


def ints(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)
