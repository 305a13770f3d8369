"""Lists of words in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PORTION_WORDS = 1 << 19


def portions(lists: pa.Array, most: int = PORTION_WORDS) -> Iterator[pa.Array]:
    """Slices of neighbouring lists: about ``most`` words together, or a single longer list."""
    before = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)) // most
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1), len(lists)] if len(lists) else [0]
    for lo, hi in zip(cuts, cuts[1:]):
        yield lists.slice(int(lo), int(hi - lo))


def owners(lists: pa.Array) -> np.ndarray:
    """The place of the list that each word stands in."""
    return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
