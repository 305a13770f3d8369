"""What the operators share: keys, text buffers, word spans and vectorised hashes.

Texts travel to Python in Arrow batches.  There a batch is cut into slices of whole documents of
about ``SLICE_BYTES`` and each slice is worked on as one flat byte array, so memory depends on the
slice (or on the longest single text), not on the table.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docsignal.session import materialize  # noqa: F401  re-exported for the operators

#: Stands for a NULL key inside an operator, so that joins and minima treat it as one smallest key.
NULL_KEY = -(1 << 63)
SLICE_BYTES = 1 << 21

# What separates words, and the letters that are lower-cased.
WORD_BREAKS = b"\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def key_column(key: str = "doc_id") -> F.Column:
    """The key as a long, NULL as ``NULL_KEY``."""
    return F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NULL_KEY))


def key_back(column: str) -> F.Column:
    """The key as callers know it: ``NULL_KEY`` becomes NULL again."""
    return F.nullif(F.col(column), F.lit(NULL_KEY))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one byte array and the offsets of its rows (NULL counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_slices(
    buffer: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of runs of whole rows of about ``limit`` bytes."""
    rows, i = len(offsets) - 1, 0
    while i < rows:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), rows)
        yield i, j, buffer[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


class PrefixHash:
    """Prefix polynomial hashes of byte arrays, modulo 2**64, over randomly mapped bytes.

    ``span(sums, start, end)`` is the hash of ``bytes[start:end]`` wherever it stands.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            size = 1 << int(len(data) + 1).bit_length()
            self.up, self.down = (_powers(b, size) for b in (self.BASE, pow(self.BASE, -1, 1 << 64)))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def span(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def ascii_lower(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + upper.astype(np.uint8) * np.uint8(32)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, row)`` of every word ``[^\\x20\\x09-\\x0D]+``; words end with their row."""
    is_word = np.ones(256, bool)
    is_word[list(WORD_BREAKS)] = False
    inside = is_word[data]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    at = cuts[cuts < len(data)]
    first[at] |= inside[at]
    at = cuts[cuts > 0] - 1
    last[at] |= inside[at]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` that hands unused memory back after each task.

    Python workers live on; without this each would hold the largest working set it ever had.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(run, schema)


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` as an Arrow list column."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def key_bitmap(keys: DataFrame, column: str, bits: int = 26) -> np.ndarray:
    """Which hashed keys occur: 2**bits bits (8 MB by default), whatever the number of keys.

    A pass over a large table uses it to leave out rows that cannot match before they are shuffled.
    Bits of other keys may coincide, so a set bit only says "maybe" and an exact join must follow;
    with very many keys the filter passes more rows and never loses one.
    """
    low = F.col(column).bitwiseAND((1 << bits) - 1)
    words = (
        keys.select(low.alias("b"))
        .groupBy(F.shiftright("b", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("w"))
    )
    found = words.toArrow()
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[found["word"].to_numpy()] = found["w"].to_numpy()
    return bitmap.astype("<i8", copy=False).view("<u4")


def maybe_in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each 64-bit key whether its bit is set (see ``key_bitmap``)."""
    low = keys.astype(np.uint64) & np.uint64(len(bitmap) * 32 - 1)
    return (bitmap[low >> np.uint64(5)] >> (low & np.uint64(31)).astype(np.uint32)) & 1 == 1
