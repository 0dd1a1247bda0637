"""Steps of the kernels that work on arrays instead of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of the owner of each of so many items in turn, and the item's place among its owner's."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def shares(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Stretches of owners with about ``most`` items, at least one owner each."""
    total, start = np.cumsum(counts), 0
    while start < len(counts):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + most, "right")))
        yield slice(start, end)
        start = end
