"""Periodic run detection: stretches of words that repeat with one period.

A run is a stretch of words with smallest period q, at least ``LEAST_WORDS`` and ``LEAST_PERIODS * q``
words long, that no neighbouring word extends.  Runs are read off an enhanced suffix array of the
words (ranks, suffix order, common prefixes); no tree node is ever built:

* words of different documents get different numbers, so a batch of documents is one array in which
  no two documents share a prefix;
* ranks of the first 1, 2, 4, ... words come from prefix doubling over the still tied suffixes.
  They are kept: equal ranks mean equal words, so any two stretches are compared exactly in two
  look-ups, without hashes;
* an LCP interval of depth d is split at its boundaries, one after the other.  For every suffix i of
  the smaller part the rank of i + d and of i - d is looked up: if it lies in the larger part, two
  equal halves of d words meet there and part after them (a branching square);
* every run has just one branching square of its period, its last one.  Turning it to the left, word
  by word, finds the start; squares of multiples of the period give the same stretch and are merged.

Two suffixes of a run share at least ``SHARED`` words, so documents without such a repeat are left
with their words as they are.

One text is the unit of memory.  NULL and empty texts have no words and no runs; NULL keys and
repeated rows are kept as they come; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docsignal.llm.common import map_batches, text_buffer, text_slices

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: length - period is at least this for every run: a third of its length is one period at most.
SHARED = LEAST_WORDS - LEAST_WORDS // LEAST_PERIODS
#: Suffixes of smaller parts that are looked up at once.
PORTION = 1 << 20
WORD_BREAK = "[\\x20\\x09-\\x0D]+"

SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


def prefix_ranks(symbols: np.ndarray, most: int | None = None) -> list[np.ndarray]:
    """``ranks[e][i]``: place of the first 2**e symbols from i on among all; equal means the same.

    Ends when no two are the same (then the last entry is the inverse suffix array), or after
    prefixes of ``most`` symbols.  Each entry ends with one more, -1, for the end.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    fresh = np.append(True, np.diff(symbols[order]) != 0)
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n, dtype=np.int32), 0))
    ranks, width = [rank], 1
    tied = order[~(fresh & np.append(fresh[1:], True))]
    while len(tied) and (most is None or width < most):
        key = rank[tied].astype(np.int64) * (n + 1) + rank[np.minimum(tied + width, n)] + 1
        o = np.argsort(key, kind="stable")
        tied, key = tied[o], key[o]
        group = rank[tied]
        at = np.arange(len(tied), dtype=np.int32)
        first = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), at, 0))
        fresh = np.append(True, key[1:] != key[:-1])
        rank = rank.copy()
        rank[tied] = np.maximum.accumulate(np.where(fresh, group + at - first, 0))
        ranks.append(rank)
        tied = tied[~(fresh & np.append(fresh[1:], True))]
        width *= 2
    return ranks


def _same(ranks: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` symbols from ``a`` and from ``b`` (a < b, length >= 1) are equal."""
    level = np.minimum(np.log2(length).astype(np.int64), len(ranks) - 1)
    end = length - (np.int64(1) << level)
    return (ranks[level, a] == ranks[level, b]) & (ranks[level, a + end] == ranks[level, b + end])


def _common_prefixes(ranks: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Words shared by each suffix and the one before it in suffix order; -1 for the first."""
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        equal = (ranks[level, a] == ranks[level, b]).astype(np.int64) << level
        shared, a, b = shared + equal, a + equal, b + equal
    return np.append(-1, shared)


def _parts(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each boundary the ends of its two parts: ``[left, boundary)`` and ``[boundary, right)``.

    The interval of depth d is split at the first of its boundaries of depth d, then the rest at
    the next, so two suffixes are told apart by exactly one boundary.
    """
    n = len(lcp)
    left, right, open_at = [0] * n, [n] * n, []
    depth = lcp.tolist()
    for r, d in enumerate(depth):
        while open_at and depth[open_at[-1]] > d:
            right[open_at.pop()] = r
        left[r] = open_at[-1] if open_at else 0
        open_at.append(r)
    return np.array(left), np.array(right)


def _squares(rank: np.ndarray, order: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(start, period)`` of all branching squares, in portions."""
    left, right = _parts(lcp)
    at = np.flatnonzero(lcp >= 1)
    left, right, depth = left[at], right[at], lcp[at]
    low = at - left <= right - at  # the smaller part is the left one
    begin, size = np.where(low, left, at), np.where(low, at - left, right - at)
    other, stop = np.where(low, at, left), np.where(low, right, at)
    sums, i = np.append(0, np.cumsum(size)), 0
    while i < len(at):
        j = max(int(np.searchsorted(sums, sums[i] + PORTION, "right")) - 1, i + 1)
        node = np.repeat(np.arange(i, j), size[i:j])
        suffix = order[np.arange(len(node)) - (sums[node] - sums[i]) + begin[node]]
        d, lo, hi = depth[node], other[node], stop[node]
        for partner in (suffix + d, suffix - d):
            inside = partner >= 0
            place = rank[np.where(inside, np.minimum(partner, len(rank) - 1), -1)]
            hit = inside & (place >= lo) & (place < hi)
            yield np.minimum(suffix, partner)[hit], d[hit]
        i = j


def word_runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs, by start and period."""
    ranks = np.stack(prefix_ranks(symbols))
    rank, n = ranks[-1], len(symbols)
    order = np.empty(n, np.int64)
    order[rank[:-1]] = np.arange(n)
    found = [np.zeros((3, 0), np.int64)]
    for start, period in _squares(rank, order, _common_prefixes(ranks, order)):
        end, least = start + 2 * period, np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        ok = end >= least
        end, period, least = end[ok], period[ok], least[ok]
        ok = _same(ranks, end - least, end - least + period, least - period)
        start, end, period = (end - least)[ok], end[ok], period[ok]
        for level in range(len(ranks) - 1, -1, -1):  # turn the squares further to the left
            back = np.maximum(start - (1 << level), 0)
            equal = (start >= 1 << level) & (ranks[level, back] == ranks[level, back + period])
            start = np.where(equal, back, start)
        found.append(np.stack([start, end, period]))
    start, end, period = np.concatenate(found, axis=1)
    o = np.lexsort((period, end, start))
    start, end, period = start[o], end[o], period[o]
    new = np.append(True, (np.diff(start) != 0) | (np.diff(end) != 0))[: len(start)]
    start, end, period = start[new], end[new], period[new]
    o = np.lexsort((period, start))
    return start[o], (end - start)[o], period[o]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers that differ between documents, and where each document starts."""
    numbers, base = [], 0
    for words in texts:
        codes: dict[bytes, int] = {}
        numbers.append(np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words)) + base)
        base += len(codes)
    bounds = np.append(0, np.cumsum([len(x) for x in numbers]))
    return np.concatenate(numbers) if numbers else np.zeros(0, np.int64), bounds


def _documents_with_repeats(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The documents in which ``SHARED`` words stand at two places."""
    if not len(symbols):
        return np.zeros(0, np.int64)
    ranks = prefix_ranks(symbols, SHARED)
    if 1 << (len(ranks) - 1) < SHARED:
        return np.zeros(0, np.int64)
    place = np.sort(ranks[-1][:-1])
    tied = np.isin(ranks[-1][:-1], place[1:][place[1:] == place[:-1]])
    return np.unique(np.searchsorted(bounds, np.flatnonzero(tied), "right") - 1)


def runs_of(texts: list[list[bytes]]) -> dict[int, list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of each document of words that has some."""
    symbols, bounds = _numbered(texts)
    rows = _documents_with_repeats(symbols, bounds)
    if not len(rows):
        return {}
    part = np.concatenate([symbols[bounds[r] : bounds[r + 1]] for r in rows])
    starts = np.append(0, np.cumsum(bounds[rows + 1] - bounds[rows]))
    out: dict[int, list[tuple[int, int, int]]] = {}
    for start, length, period in zip(*(x.tolist() for x in word_runs(part))):
        n = int(np.searchsorted(starts, start, "right")) - 1
        out.setdefault(int(rows[n]), []).append((start - int(starts[n]), length, period))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
    return b" ".join(words)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, (data, offsets) = batch.column(0), text_buffer(batch.column(1))
        for i, j, part, ends in text_slices(data, offsets):
            texts = [part[a:b].tobytes().split() for a, b in zip(ends[:-1], ends[1:])]
            runs = runs_of(texts)
            listed = [
                [{"start": s, "length": n, "period": p} for s, n, p in runs.get(r, ())] for r in range(j - i)
            ]
            kept = [_collapsed(words, runs.get(r, [])) for r, words in enumerate(texts)]
            kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    keys.slice(i, j - i),
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.array(listed, pa.list_(kind)),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row; ``runs`` by start, then period.

    ``collapsed`` holds the words that no run contains after its first period.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_batches(rows, _batches, SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """The documents with runs planted in about one of ten, chosen and shaped by a hash of the key.

    With h the CRC-32 of the decimal key, g = h div 10 and n words: where h mod 10 = 0 and n > 0, word
    i >= a becomes word a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    words = F.array_remove(F.split("text", WORD_BREAK), "")
    rows = rows.withColumn("words", F.when(F.col("chosen"), words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    rows = rows.withColumn("p", period)
    again = F.transform(
        "words",
        lambda w, i: F.when(i < F.col("a"), w).otherwise(
            F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
        ),
    )
    text = F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """One line a document about its runs; the longest by exponent, of equal ones the first."""
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        exponent.cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
