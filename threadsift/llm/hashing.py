"""Vectorised hashes of words and word sequences over Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that one step works on; some fifty times as much memory is used.
STEP_BYTES = 1 << 21
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    size = max(1 << 16, 1 << (int(n) - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _BASE, U64), np.full(size, _INVERSE, U64)
        up[0] = down[0] = 1
        _powers[size] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _powers[size][0][:n], _powers[size][1][:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text begins and the last one ends. NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def groups(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``most`` bytes together; a longer text is a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin and the last ones end.

    Words are runs of bytes other than space and 09 to 0D; A-Z count as a-z.
    """
    data = LOWER[data]
    inside = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + STEP_BYTES, "right")))
        a, b = starts[i], ends[j - 1]
        up, down = powers(b - a)
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(BYTE_VALUES[data[a:b]] * up, dtype=U64)))
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64))
        i = j
    return out, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of k words of each text, and their offsets. A text of fewer words, but not none, has one
    hash of all its words."""
    counts = np.diff(at)
    have = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out_at = np.concatenate(([0], np.cumsum(have)))
    if not out_at[-1]:
        return np.zeros(0, U64), out_at
    full = max(0, len(words) - k + 1)
    rolled = np.full(full, U64(k), U64)
    for d in range(k):
        rolled = rolled * U64(0x9FB21C651E98DF25) + words[d : d + full]
    rolled = mix(rolled)
    out = np.empty(out_at[-1], U64)
    long = counts >= k
    own = np.repeat(np.flatnonzero(long), have[long])
    within = np.arange(len(own)) - np.repeat(np.concatenate(([0], np.cumsum(have[long])))[:-1], have[long])
    out[np.repeat(out_at[:-1][long], have[long]) + within] = rolled[at[:-1][own] + within]
    for i in np.flatnonzero((counts > 0) & ~long):
        h = np.array([0xA0761D6478BD642F + int(counts[i])], U64)
        for w in range(at[i], at[i + 1]):
            h = h * U64(0x9FB21C651E98DF25) + words[w : w + 1]
        out[out_at[i]] = mix(h)[0]
    return out, out_at


def segment_min(values: np.ndarray, at: np.ndarray, empty) -> np.ndarray:
    """The least value of each segment; ``empty`` for a segment without any."""
    out = np.full(len(at) - 1, empty, values.dtype)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        out[some] = np.minimum.reduceat(values, at[:-1][some])
    return out


def segment_sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at) - 1, np.float64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        out[some] = np.add.reduceat(values, at[:-1][some], dtype=np.float64)
    return out
