"""Whole texts as numpy arrays, for functions that run on Arrow batches inside tasks.

A null text counts as an empty one. Words are maximal runs of bytes other than space and
``\\x09`` to ``\\x0D``; all of these are single bytes in UTF-8, so bytes can be cut directly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes looked at together; one longer text is taken alone. It bounds memory, not results.
SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(size, BASE, np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse modulo 2**64."""
    return tuple(p[:size] for p in _powers(max(SLICE_BYTES + 1, 1 << (size - 1).bit_length())))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Well spread 64-bit values."""
    x = (x + np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


@dataclass
class Slice:
    """Some neighbouring texts of a batch: their bytes and where each begins and ends."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, "right") - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the maximal runs of marked bytes that stay inside a text."""
        before = np.zeros(len(member), bool)
        before[1:] = member[:-1]
        after = np.zeros(len(member), bool)
        after[:-1] = member[1:]
        edges = self.offsets[:-1][self.offsets[:-1] < len(member)]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
        return np.flatnonzero(member & ~before), np.flatnonzero(member & ~after) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(~is_space(self.data))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each range; equal bytes give equal hashes."""
        up, down = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        return mixed((total[ends] - total[starts]) * down[starts])


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[Slice]:
    """The texts of a column, in order, in pieces of bounded size."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last), first + rows)
        yield Slice(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def grams(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of ``size`` words inside a text, and the place of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * BASE + hashes[i : i + n]
    at = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return mixed(total[at], size), at
