"""Ranked lexical search over hashed max-sketches.

*Index.*  For every document one line: its length in terms and ``WIDTH`` small numbers.  Each term is
hashed to one coordinate, which holds the largest frequency of the terms that fall there (a number of
one byte; ``FULL`` stands for itself and all above).  In one document impacts rise with the frequency
alone, so maxima of frequencies are maxima of impacts, and the index needs no figure of the corpus.

*Search.*  The queries' terms are counted over all documents, then every task takes its documents in
portions.  One product of two matrices (impacts at the coordinates, weights of the queries' terms)
gives upper bounds for all pairs of a portion; all numbers are integers below 2 ** 53, so the product
is exact.  The portion's documents are taken by descending bound, read once and scored exactly for all
queries together, as long as a bound reaches the k-th best score that the task has seen for its query.  Tasks
return at most k lines a query; a window picks the best of these.

Scores are those of ``score``: weights and impacts are integers, ties go to the smaller key.  NULL
texts have no term and are found by no query.  A NULL key is the smallest; rows that repeat a key are
documents of their own.  Rows of one query key make one query of all their terms; a NULL query key is a
key like others.  Queries without a known term return no row; so does an empty table.  Queries are
worked on in blocks of about ``BLOCK_BYTES`` of text, each with its own pass, so what a task gets
is bounded; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docsignal.llm.common import (
    NULL_KEY, PrefixHash, ascii_lower, key_back, key_column, map_batches, materialize, text_buffer,
    text_slices,
)

WIDTH, FULL = 1024, 255
BLOCK_BYTES = 4 << 20
#: Documents and queries in one product.
ROWS, COLUMNS = 512, 512
#: Impacts are below this, reached by a term without end in a text without length.
MOST_IMPACT = 1_000_000

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_IN_TERM = np.array([TERM.fullmatch(bytes([b])) is not None for b in range(256)])


def terms_of(text: bytes) -> list[bytes]:
    """All terms of a text, A-Z lower-cased, in order."""
    return TERM.findall(text.lower())  # bytes.lower() changes A-Z only


def _term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, row)`` of every term; terms end with their row."""
    inside = np.zeros(len(data) + len(offsets), np.int8)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(len(data)) + row + 1  # a gap before every row
    inside[at] = _IN_TERM[data]
    edge = np.diff(inside, prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    gaps = np.searchsorted(offsets + np.arange(len(offsets)), start, "right")
    return start - gaps, end - gaps, gaps - 1


def coordinate(hashes: np.ndarray) -> np.ndarray:
    """Where terms with these hashes fold."""
    return (hashes >> np.uint64(40)).astype(np.int64) % WIDTH


def _hashes(hasher: PrefixHash, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    lower = ascii_lower(data)
    return hasher.span(hasher.sums(lower), start, end) * np.uint64(0x9E3779B97F4A7C15)


def term_hash(hasher: PrefixHash, term: bytes) -> int:
    data = np.frombuffer(term, np.uint8)
    return int(_hashes(hasher, data, np.array([0]), np.array([len(data)]))[0])


def sketches(data: np.ndarray, offsets: np.ndarray, hasher: PrefixHash) -> tuple[np.ndarray, np.ndarray]:
    """Terms and sketch of every row.

    Terms whose hashes agree would count as one: maxima can only be too large by it, never too small.
    """
    rows = len(offsets) - 1
    start, end, row = _term_spans(data, offsets)
    sketch = np.zeros(rows * WIDTH, np.int64)
    if len(start):
        hashes = _hashes(hasher, data, start, end)
        cell = row * WIDTH + coordinate(hashes)
        order = np.lexsort((hashes, cell))
        cell, hashes = cell[order], hashes[order]
        first = np.flatnonzero(np.append(True, (np.diff(cell) != 0) | (np.diff(hashes) != 0)))
        count = np.diff(np.append(first, len(cell)))
        np.maximum.at(sketch, cell[first], count)
    counts = np.bincount(row, minlength=rows)
    return counts, np.minimum(sketch, FULL).astype(np.uint8).reshape(rows, WIDTH)


def index_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, n_terms, sketch``: the index, one line a document, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PrefixHash()
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j, part, ends in text_slices(data, offsets):
                counts, sketch = sketches(part, ends, hasher)
                places = pa.py_buffer(np.arange(0, (j - i + 1) * WIDTH, WIDTH, dtype=np.int32))
                lines = pa.Array.from_buffers(
                    pa.binary(), j - i, [None, places, pa.py_buffer(sketch.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array(counts, pa.int64()), lines],
                    names=["doc_id", "text", "n_terms", "sketch"],
                )

    rows = docs.select(key_column(key).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = map_batches(rows, run, "doc_id long, text string, n_terms long, sketch binary")
    return materialize(found, "search-index")


@dataclass
class Queries:
    """A block of queries: the terms of each (as numbers), and all terms of the block."""

    keys: list[int]
    terms: list[list[int]]
    vocabulary: list[bytes]


def query_block(rows: list) -> Queries:
    """Rows ``(key, text)``; terms count once a query."""
    together: dict[int, set[bytes]] = {}
    for key, text in rows:
        together.setdefault(key, set()).update(terms_of((text or "").encode()))
    vocabulary = sorted(set().union(*together.values()))
    number = {t: n for n, t in enumerate(vocabulary)}
    keys = sorted(together)
    return Queries(keys, [sorted(number[t] for t in together[k]) for k in keys], vocabulary)


def document_frequencies(index: DataFrame, vocabulary: list[bytes]) -> list[int]:
    """In how many documents each term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: n for n, t in enumerate(vocabulary)}
        known = number.keys()
        found = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for i in range(batch.num_rows):
                own = known & terms_of(data[offsets[i] : offsets[i + 1]].tobytes())
                found[[number[t] for t in own]] += 1
        n = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(found[n])], names=["term", "df"])

    if not vocabulary:
        return []
    counts = map_batches(index.select("text"), run, "term long, df long")
    out = [0] * len(vocabulary)
    for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return out


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_share(n_terms, documents: int, terms: int):
    """m of a document (or an array of them): 100 for one of mean length."""
    return 100 - 90 + (90 * n_terms * documents) // terms


def impact(tf, m):
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class _Best:
    """The k best (score, smallest key first) that a task has seen for one query."""

    def __init__(self, k: int) -> None:
        self.k, self.heap = k, []

    def least(self) -> int:
        """What a document must reach to come in."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, key: int) -> None:
        if score > 0:
            (heapq.heappush if len(self.heap) < self.k else heapq.heappushpop)(self.heap, (score, -key))


class _Asked:
    """Some queries of a block, with their terms one after the other."""

    def __init__(self, terms: list[list[int]], weights: np.ndarray) -> None:
        self.terms = np.array([t for own in terms for t in own], np.int64)
        self.weights = weights[self.terms]
        self.ends = np.cumsum([0] + [len(own) for own in terms])

    def scores(self, impacts: np.ndarray) -> np.ndarray:
        """Exact scores of one document, whose impacts stand at the numbers of its terms."""
        sums = np.zeros(len(self.terms) + 1, np.int64)
        np.cumsum(self.weights * impacts[self.terms], out=sums[1:])
        return sums[self.ends[1:]] - sums[self.ends[:-1]]


class _Portion:
    """Documents of a portion; the impacts of each are taken from its words once, if at all."""

    def __init__(self, keys, data, offsets, m, number: dict[bytes, int]) -> None:
        self.keys, self.data, self.offsets, self.m, self.number = keys, data, offsets, m, number
        self.seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.line = np.zeros(len(number), np.int64)

    def impacts(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """``(term numbers, impacts)`` of the document's terms that any query has."""
        if row not in self.seen:
            text = self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()
            number = self.number
            tf = Counter(n for n in map(number.get, terms_of(text)) if n is not None)
            at = np.fromiter(tf.keys(), np.int64, len(tf))
            self.seen[row] = at, impact(np.fromiter(tf.values(), np.int64, len(tf)), int(self.m[row]))
        return self.seen[row]

    def rank(self, bounds: np.ndarray, asked: _Asked, best: list[_Best]) -> None:
        """Score documents by descending bound until none can come in for any query."""
        least = np.array([top.least() for top in best])
        above = (bounds - least).max(axis=1, initial=-np.inf)
        rows = np.flatnonzero(above >= 0)
        for row in rows[np.argsort(-above[rows], kind="stable")].tolist():
            if not (bounds[row] >= least).any():
                continue
            at, values = self.impacts(row)
            self.line[at] = values
            scores = asked.scores(self.line)
            self.line[at] = 0
            for q in np.flatnonzero(scores >= least).tolist():
                best[q].add(int(scores[q]), int(self.keys[row]))
                least[q] = best[q].least()


def _search_block(index: DataFrame, queries: Queries, documents: int, terms: int, k: int) -> DataFrame:
    frequencies = document_frequencies(index, queries.vocabulary)
    weights = np.array([weight(df, documents) for df in frequencies], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PrefixHash()
        at = coordinate(np.array([term_hash(hasher, t) for t in queries.vocabulary], np.uint64))
        used, place = np.unique(at, return_inverse=True)
        asked = np.zeros((len(used), len(queries.keys)))
        for q, own in enumerate(queries.terms):
            np.add.at(asked[:, q], place[own], [weights[t] for t in own])
        best = [_Best(k) for _ in queries.keys]
        parts = range(0, len(queries.keys), COLUMNS)
        blocks = [_Asked(queries.terms[c : c + COLUMNS], weights) for c in parts]
        number = {t: n for n, t in enumerate(queries.vocabulary)}
        for batch in batches:
            names = batch.column(0).to_numpy()
            data, offsets = text_buffer(batch.column(1))
            lengths = batch.column(2).to_numpy()
            lines, _ = text_buffer(batch.column(3))
            lines = lines.reshape(-1, WIDTH)
            for i in range(0, len(names), ROWS):
                part = slice(i, min(i + ROWS, len(names)))
                m = length_share(lengths[part].astype(object), documents, terms)
                tf = lines[part][:, used].astype(np.int64)
                most = impact(tf, m.astype(np.int64)[:, None])
                most[tf == FULL] = MOST_IMPACT
                portion = _Portion(names[part], data, offsets[i : part.stop + 1], m, number)
                for c, own in zip(parts, blocks):
                    bounds = most.astype(np.float64) @ asked[:, c : c + COLUMNS]
                    portion.rank(bounds, own, best[c : c + COLUMNS])
        found = [(queries.keys[q], -key, score) for q, top in enumerate(best) for score, key in top.heap]
        columns = zip(*found) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"]
        )

    return map_batches(
        index.select("doc_id", "text", "n_terms", "sketch"), run, "item_id long, doc_id long, score long"
    )


def search(index: DataFrame, queries: DataFrame, k: int = 10, key: str = "item_id", text: str = "text") -> DataFrame:
    """The k best documents of every query: ``item_id, rank, doc_id, score``."""
    spark = index.sparkSession
    asked = queries.select(key_column(key).alias("item_id"), F.col(f"`{text}`").alias("text"))
    figures = index.agg(
        F.count(F.when(F.col("n_terms") > 0, 1)).alias("documents"), F.sum("n_terms").alias("terms")
    ).first()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    found = None
    for block in range(blocks if figures["documents"] else 0):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        own = query_block(rows)
        if own.vocabulary:
            part = _search_block(index, own, figures["documents"], figures["terms"], k)
            found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select(key_back("item_id").alias("item_id"), "rank", key_back("doc_id").alias("doc_id"), "score")
