"""Vectorised text primitives used inside Arrow tasks.

Everything here works on the flat UTF-8 buffer of an Arrow string column, so
the per-row cost is numpy work, not Python objects.  Nulls read as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
# odd multiplier of the polynomial hashes and its inverse modulo 2**64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)

# byte classes: white space [\x20\x09-\x0D] and its complement
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# A-Z to a-z, every other byte unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n (kept, and grown by doubling)."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        up = np.full(size, BASE, dtype=U64)
        down = np.full(size, BASE_INV, dtype=U64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)]
    return _powers[0][:n], _powers[1][:n]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat bytes and row offsets (len + 1, from 0) of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + n + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def parts(column, limit: int = 2 << 20, rows: int = 1 << 16):
    """Split into runs of about ``limit`` bytes and at most ``rows`` rows (one
    longer row stays whole): yields (first row, flat bytes, offsets)."""
    data, offsets = utf8(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, first + rows, n)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """Start, end and row of every maximal run of non-``space`` bytes."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~space[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    first[cut] = solid[cut]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[cut - 1] = solid[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


class Rolling:
    """Polynomial hashes of any range of a symbol sequence, by prefix sums."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.up, down = powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, dtype=U64)
        np.cumsum(symbols * down[:self.n], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of symbols[start:end]; equal contents hash alike."""
        h = (self.sums[end] - self.sums[start]) * self.up[start]
        return mix(h + (end - start).astype(U64) * U64(0xA0761D6478BD642F))

    def grams(self, k: int) -> np.ndarray:
        """Hash of every k consecutive symbols."""
        h = (self.sums[k:] - self.sums[:self.n + 1 - k]) * self.up[:self.n + 1 - k]
        return mix(h + U64(k * 0xA0761D6478BD642F & (1 << 64) - 1))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Rolling(BYTE_CODE[data]).spans(starts, ends)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in log2(width) passes."""
    have = 1
    while have * 2 <= width:
        a = np.minimum(a[:-have], a[have:])
        have *= 2
    extra = width - have
    return np.minimum(a[:-extra], a[extra:]) if extra else a


class SuperWindows:
    """Runs of consecutive windows that share their anchor.

    A window is ``length`` consecutive symbols of one row; its anchor is the
    first of its ``k``-grams with the smallest hash.  The choice depends on
    the window's content alone, so equal windows have equal anchors
    wherever they occur, and a window whose anchor occurs once is unique.
    Arrays by run: ``start`` (first window), ``count`` (windows), ``anchor``
    (hash of the anchor's k-gram), ``lead`` (symbols before it).
    """

    def __init__(self, symbols: np.ndarray, row: np.ndarray, length: int, k: int):
        n = len(symbols)
        self.rolling = Rolling(symbols)
        self.length = length
        if n < length:
            z = np.zeros(0, np.int64)
            self.start, self.count, self.lead, self.anchor = z, z, z, np.zeros(0, U64)
            return
        valid = row[:n - length + 1] == row[length - 1:]
        grams = self.rolling.grams(k)
        # 32 bits of the hash, then the position: the smallest is the first
        # of the smallest, whatever the size of the batch
        keyed = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U64)
        place = (sliding_min(keyed, length - k + 1) & U64(0xFFFFFFFF)).astype(np.int64)
        at = np.flatnonzero(valid)
        if len(at) == 0:
            z = np.zeros(0, np.int64)
            self.start, self.count, self.lead, self.anchor = z, z, z, np.zeros(0, U64)
            return
        new = np.ones(len(at), dtype=bool)
        new[1:] = (place[at[1:]] != place[at[:-1]]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        self.start = at[first]
        self.count = np.diff(np.append(first, len(at)))
        self.lead = place[self.start] - self.start
        self.anchor = grams[place[self.start]]

    def windows(self, pick: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(window start, run index) of every window of the picked runs."""
        runs = np.arange(len(self.start)) if pick is None else pick
        return spread(self.start[runs], self.count[runs], runs)

    def prints(self, at: np.ndarray) -> np.ndarray:
        """64-bit fingerprint of the windows that start at ``at``."""
        return self.rolling.spans(at, at + self.length)


def spread(start: np.ndarray, count: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """start[i], start[i] + 1, ... (count[i] values) for each i, with label[i]."""
    total = int(count.sum())
    base = np.repeat(start - np.append(0, np.cumsum(count)[:-1]), count) if total else np.zeros(0, np.int64)
    return base + np.arange(total), np.repeat(label, count)


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Membership in a sorted array."""
    if len(ordered) == 0:
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values
