"""Removal of long repeated passages by suffix sorting, spread over buckets.

Every byte position of every text starts a suffix, of which the first ``LENGTH`` bytes matter: its
*window*.  Equal windows contain the same least-hashed ``GRAM``-byte gram (of equal ones the first),
so windows that share a gram stand together: consecutive windows with one such gram form a *block*
of text, and all blocks of a gram meet in one bucket.

1. A pass over the texts emits the grams; those that occur in two documents or more are kept in a
   bitmap of bounded size.
2. A second pass emits the blocks of these grams.  Of equal blocks in a batch only that of the
   smallest document travels; the others are covered already.
3. In each bucket equal blocks are merged and the suffixes of the rest are sorted by their bytes,
   eight at a time: a round sorts only those that have been equal so far.  The smallest document of
   each run of equal windows keeps its bytes.
4. The covered spans are joined with the texts.

A gram with more than ``LIMIT`` different blocks (say, at the edge of a passage that a third of all
documents share) is not sorted in one task: its windows are grouped by a shuffle instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from docsignal.llm.common import (
    PrefixHash, key_back, key_bitmap, key_column, map_batches, maybe_in, mix, materialize,
    text_buffer, text_slices,
)
from docsignal.session import no_shuffles_left

LENGTH, GRAM = 50, 16
SLICE, PACK = 1 << 17, 4 << 20  # bytes of text worked on at once (in the cache), and packed into one batch of blocks
CHUNK = 16_000  # blocks sorted at once in a task
LIMIT = 1 << 15
BITMAP_BITS, MOST_BITS = 27, 29
WORD = 8  # bytes that suffixes are sorted by in one round


# ---- blocks -------------------------------------------------------------------------------------


def find_blocks(data: np.ndarray, offsets: np.ndarray, hasher: PrefixHash, length: int, gram: int):
    """``(gram hash, row, start, windows)`` of the blocks of a slice of texts.

    A block covers ``windows + length - 1`` bytes from ``start``.
    """
    n, width = len(data), length - gram + 1
    if n < length:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    grams = n - gram + 1
    hashes = mix(hasher.span(hasher.sums(data), np.arange(grams), np.arange(gram, n + 1)))
    bits = np.uint64((1 << int(n).bit_length()) - 1)
    least = (hashes & ~bits) | np.arange(grams, dtype=np.uint64)
    size = 1
    while size * 2 <= width:  # minima over doubling ranges
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    place = (least & bits).astype(np.int64)
    window = np.arange(n - length + 1)
    row = np.searchsorted(offsets, window, "right") - 1
    whole = window + length <= offsets[row + 1]
    change = np.ones(len(window), bool)
    change[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, len(window)))
    first, count = first[whole[first]], count[whole[first]]
    return hashes[place[first]], row[first], first, count


def _cut_bytes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The byte strings ``data[start : start + size]`` (none empty) as an Arrow column."""
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.ones(ends[-1], np.int32)
    at[ends[:-1]] = start
    at[ends[1:-1]] -= (start + size - 1)[:-1].astype(np.int32)
    flat = data[np.cumsum(at, out=at)] if len(at) else np.zeros(0, np.uint8)
    return pa.Array.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)]
    )


def gram_keys(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``key`` of each gram: once a batch, or twice if several of its documents have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PrefixHash()
        for batch in batches:
            keys = batch.column(0).to_numpy()
            found = []
            for i, _, data, offsets in text_slices(*text_buffer(batch.column(2)), SLICE):
                key, row, _, _ = find_blocks(data, offsets, hasher, length, gram)
                order = np.lexsort((keys[i + row], key))
                key, doc = key[order], keys[i + row][order]
                fresh = np.ones(len(key), bool)
                fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                found.append(key[fresh])
            key = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)
            third = np.zeros(len(key), bool)
            third[2:] = key[2:] == key[:-2]
            yield pa.RecordBatch.from_arrays([pa.array(key[~third].view(np.int64))], names=["key"])

    return map_batches(docs, run, "key long")


def repeated(keys: DataFrame) -> DataFrame:
    """The keys that come more than once; each task streams through its sorted share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told = None, False
        for batch in batches:
            key = batch.column(0).to_numpy()
            if not len(key):
                continue
            if last is not None:
                key = np.append([last], key)
            again = np.zeros(len(key), bool)
            again[1:] = key[1:] == key[:-1]
            found = np.unique(key[again])
            if told and len(found) and found[0] == last:
                found = found[1:]
            told = bool(again[-1]) or (told and key[-1] == last)
            last = key[-1]
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["key"])

    return map_batches(keys.repartition("key").sortWithinPartitions("key"), run, "key long")


BLOCK_SCHEMA = "key int, doc_id long, tag long, start long, size int, block binary"


def shared_blocks(docs: DataFrame, bitmap: np.ndarray, length: int, gram: int) -> DataFrame:
    """Blocks whose gram may be repeated.  ``block`` is NULL where a smaller document covers it."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PrefixHash()
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts, blocks, held = [], [], 0
            buffer, ends = text_buffer(batch.column(2))
            for i, j, data, offsets in text_slices(buffer, ends, SLICE):
                key, row, start, count = find_blocks(data, offsets, hasher, length, gram)
                take = maybe_in(shared.value, key)
                key, row, start, count = (c[take] for c in (key, row, start, count))
                size = count + length - 1
                blocks.append(_cut_bytes(data, start, size))
                parts.append((key, row + i, start - offsets[row], size))
                held += len(data)
                if held >= PACK or j == batch.num_rows:
                    yield pack(ids, tags, parts, blocks)
                    parts, blocks, held = [], [], 0

    def pack(ids, tags, parts, blocks) -> pa.RecordBatch:
        key, row, start, size = (np.concatenate(c) for c in zip(*parts))
        doc, block = ids[row], pa.concat_arrays(blocks)
        code = block.dictionary_encode().indices.to_numpy()
        travels = doc <= _least_by(code, doc)[code]
        # Covered blocks need no meeting: spread by place, they make no bucket hot.
        key = np.where(travels, key, mix(doc.astype(np.uint64) + start.astype(np.uint64)))
        text = pc.if_else(pa.array(travels), block.cast(pa.binary()), pa.scalar(None, pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array((key >> np.uint64(33)).astype(np.int32)), pa.array(doc),
             pa.array(tags[row]), pa.array(start), pa.array(size.astype(np.int32)), text],
            names=BLOCK_NAMES,
        )

    return map_batches(docs, run, BLOCK_SCHEMA)


BLOCK_NAMES = ["key", "doc_id", "tag", "start", "size", "block"]


def _least_by(code: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The least value of each code (codes are 0 .. k - 1)."""
    if not len(code):
        return np.zeros(0, np.int64)
    order = np.argsort(code, kind="stable")
    first = np.searchsorted(code[order], np.arange(code.max() + 1))
    return np.minimum.reduceat(value[order], first)


# ---- the suffix sort ----------------------------------------------------------------------------


class Suffixes:
    """Suffixes of a byte array, of which the first ``length`` bytes count, in groups."""

    def __init__(self, data: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> None:
        self.start, self.group, self.length = start, group, length
        # The word of WORD bytes at every place, first byte most significant; a view, not a copy.
        padded = np.append(data, np.zeros(WORD, np.uint8))
        self.words = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))

    def word(self, which: np.ndarray, depth: int) -> np.ndarray:
        """The word of each suffix after ``depth`` bytes; what is beyond ``length`` is left out."""
        beyond = max(0, depth + WORD - self.length)
        return self.words[self.start[which] + depth].astype(np.uint64) >> np.uint64(8 * beyond)

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """``(order, run number per place)``: places of one number have equal windows and group.

        The suffixes sorted within their groups (``group`` ascending), equal ones by their number.
        Word by word those are sorted on that have been equal so far; the bytes themselves decide.
        """
        order = np.arange(len(self.start))
        fresh = np.ones(len(order), bool)  # the first place of each run
        fresh[1:] = self.group[1:] != self.group[:-1]
        for depth in range(0, self.length, WORD):
            at = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
            if not len(at):
                break
            word = self.word(order[at], depth)
            sort = np.lexsort((word, np.cumsum(fresh[at])))
            order[at], word = order[at[sort]], word[sort]
            fresh[at[1:]] |= word[1:] != word[:-1]
        return order, np.cumsum(fresh) - 1


# ---- buckets ------------------------------------------------------------------------------------

SPAN_SCHEMA = "doc_id long, tag long, start long, end long, window binary"
SPAN_NAMES = ["doc_id", "tag", "start", "end", "window"]


def bucket_spans(blocks: DataFrame, length: int, limit: int = LIMIT) -> DataFrame:
    """Covered spans ``(doc_id, tag, start, end)`` of blocks that met by key.

    Blocks known to be covered (``block`` NULL) come along, so that the texts are read once.
    Keys with more than ``limit`` different blocks give their windows instead (``window`` set).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.RecordBatch | None = None
        hot = None
        for batch in batches:
            direct = batch.column(5).is_null()
            yield _whole_blocks(batch.filter(direct))
            batch = batch.filter(pc.invert(direct))
            if waiting is not None:
                batch = pa.concat_batches([waiting, batch])
            waiting = batch
            while waiting.num_rows > CHUNK:
                key = waiting.column(0).to_numpy()
                last = int(np.searchsorted(key, key[-1]))  # whole keys before the last one
                if last == 0 or hot is not None:
                    # One key fills the buffer: blocks that a smaller document holds too leave it.
                    if hot is None:
                        covered, waiting = _folded(waiting)
                        yield _whole_blocks(covered)
                        if _different(waiting) > limit:
                            hot = key[0]
                            key = waiting.column(0).to_numpy()
                    if hot is None:
                        break
                    stop = int(np.searchsorted(key, hot, "right"))
                    yield _windows(waiting.slice(0, stop), length)
                    waiting = waiting.slice(stop)
                    if waiting.num_rows:
                        hot = None
                    continue
                yield from _resolve(waiting.slice(0, last), length, limit)
                waiting = waiting.slice(last)
                if waiting.num_rows <= CHUNK:
                    break
        if waiting is not None and waiting.num_rows:
            if hot is not None:
                key = waiting.column(0).to_numpy()
                stop = int(np.searchsorted(key, hot, "right"))
                yield _windows(waiting.slice(0, stop), length)
                waiting = waiting.slice(stop)
            yield from _resolve(waiting, length, limit)

    dealt = blocks.repartition("key").sortWithinPartitions("key")
    return map_batches(dealt, run, SPAN_SCHEMA)


def _folded(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """Blocks that stand in a smaller document of the batch as well, and the others."""
    doc = batch.column(1).to_numpy()
    code = batch.column(5).dictionary_encode().indices.to_numpy()
    covered = pa.array(doc > _least_by(code, doc)[code])
    return batch.filter(covered), batch.filter(pc.invert(covered))


def _different(batch: pa.RecordBatch) -> int:
    return len(batch.column(5).dictionary_encode().dictionary)


def _span_batch(doc, tag, start, end, window=None) -> pa.RecordBatch:
    window = pa.nulls(len(doc), pa.binary()) if window is None else window
    columns = [pa.array(np.asarray(doc, np.int64)), pa.array(np.asarray(tag, np.int64))]
    columns += [pa.array(np.asarray(c, np.int64)) for c in (start, end)]
    return pa.RecordBatch.from_arrays([*columns, window], names=SPAN_NAMES)


def _columns(batch: pa.RecordBatch):
    doc, tag, start, size = (batch.column(k).to_numpy() for k in range(1, 5))
    return batch.column(0).to_numpy(), doc, tag, start, size.astype(np.int64)


def _whole_blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
    _, doc, tag, start, size = _columns(batch)
    return _span_batch(doc, tag, start, start + size)


def _windows(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Every window of the blocks as a row of its own."""
    _, doc, tag, start, size = _columns(batch)
    data, offsets = text_buffer(batch.column(5))
    count = size - length + 1
    row = np.repeat(np.arange(len(doc)), count)
    within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    text = _cut_bytes(data, offsets[row] + within, np.full(len(row), length)).cast(pa.binary())
    at = start[row] + within
    return _span_batch(doc[row], tag[row], at, at + length, text)


def _resolve(batch: pa.RecordBatch, length: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The spans of a batch of whole keys."""
    if not batch.num_rows:
        return
    key, doc, tag, start, size = _columns(batch)
    coded = batch.column(5).dictionary_encode()
    code = coded.indices.to_numpy()
    least = _least_by(code, doc)
    key_of = np.zeros(len(least), np.int64)
    key_of[code] = key
    names, many = np.unique(key_of, return_counts=True)
    if (many > limit).any():
        over = np.isin(key, names[many > limit])
        yield _windows(batch.filter(pa.array(over)), length)
        yield from _resolve(batch.filter(pa.array(~over)), length, limit)
        return
    whole = doc > least[code]
    yield _span_batch(doc[whole], tag[whole], start[whole], start[whole] + size[whole])
    alone = many[np.searchsorted(names, key_of)] < 2
    sort = np.flatnonzero(~alone)
    if not len(sort):
        return
    sort = sort[np.argsort(key_of[sort], kind="stable")]
    data, offsets = text_buffer(coded.dictionary)
    count = np.diff(offsets)[sort] - length + 1
    owner = np.repeat(np.arange(len(sort)), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    found = Suffixes(data, offsets[sort][owner] + within, key_of[sort][owner], length)
    order, number = found.runs()
    first = least[sort][owner]
    lowest = np.minimum.reduceat(first[order], np.searchsorted(number, np.arange(number[-1] + 1)))
    covered = np.zeros(len(owner), bool)
    covered[order] = lowest[number] < first[order]
    # Runs of covered windows of each block, for the rows of the block's own smallest document.
    begin = covered.copy()
    begin[1:] &= ~(covered[:-1] & (owner[1:] == owner[:-1]))
    close = covered.copy()
    close[:-1] &= ~(covered[1:] & (owner[1:] == owner[:-1]))
    a, b = np.flatnonzero(begin), np.flatnonzero(close)
    place = np.full(len(least), -1)
    place[sort] = np.arange(len(sort))
    rows = np.flatnonzero(~whole & (place[code] >= 0))
    mine = place[code[rows]]
    lo, hi = np.searchsorted(owner[a], mine), np.searchsorted(owner[a], mine, "right")
    n = hi - lo
    row = np.repeat(rows, n)
    at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    yield _span_batch(
        doc[row], tag[row], start[row] + within[a[at]], start[row] + within[b[at]] + length
    )


# ---- the operator -------------------------------------------------------------------------------


def bitmap_bits(grams: int) -> int:
    """Bits of the bitmap of so many grams, as a power of two: one in eight set, between 16 and 64 MB.

    In a fuller one, blocks of no use pass and are shuffled and sorted like the others.
    """
    return min(max((8 * grams).bit_length(), BITMAP_BITS), MOST_BITS)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, limit: int = LIMIT
) -> DataFrame:
    """``(doc_id, tag, start, end)``: covered byte spans, not yet united, of ``(doc_id, tag, text)``."""
    # What the passes shuffle is of no use once their tables are written, and as large as the input or larger.
    with no_shuffles_left(docs.sparkSession):
        keys = materialize(repeated(gram_keys(docs, length, gram)), "suffix-grams")
        bitmap = key_bitmap(keys, "key", bitmap_bits(keys.count()))
        blocks = shared_blocks(docs, bitmap, length, gram)
        found = materialize(bucket_spans(blocks, length, limit), "suffix-spans")
    spans = found.where("window is null").select("doc_id", "tag", "start", "end")
    windows = found.where("window is not null")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("first"))
    more = windows.join(least, "window").where("doc_id > first")
    return spans.union(more.select("doc_id", "tag", "start", "end"))


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    limit: int = LIMIT,
    key: str = "doc_id",
    text: str = "text",
    as_text: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row: maximal removed byte spans, remaining bytes.

    ``as_text`` gives ``kept`` as a string, without characters that lost some of their bytes.
    Columns named in ``carry`` are passed through.

    A byte goes if a string of ``length`` bytes that covers it also starts in a document with a
    smaller key, judged on the texts as they came.

    NULL text counts as empty, shorter texts lose nothing.  A NULL key is smaller than any other.
    Rows repeated with one key keep each other's passages and lose the same spans.  Other columns
    are ignored; an empty table gives no rows.
    """
    docs = docs.select(
        key_column(key).alias("doc_id"),
        F.xxhash64(f"`{text}`").alias("tag"),
        F.col(f"`{text}`").alias("text"),
        *[F.col(c).alias(f"carry_{c}") for c in carry],
    )
    extra = [f"carry_{c}" for c in carry]
    spans = repeated_spans(docs.select("doc_id", "tag", "text"), length, gram, limit)
    grouped = spans.groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    rows = docs.join(grouped, ["doc_id", "tag"], "left").select("doc_id", "text", "spans", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                own = _cut_texts(part, as_text)
                yield pa.RecordBatch.from_arrays([*own, *part.columns[3:]], names=names)

    kind = "string" if as_text else "binary"
    schema = f"doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept {kind}"
    schema += "".join(f", `{c}` {docs.schema[f'carry_{c}'].dataType.simpleString()}" for c in carry)
    names = ["doc_id", "n_bytes", "spans", "kept", *carry]
    return map_batches(rows, run, schema).withColumn("doc_id", key_back("doc_id"))


def _cut_texts(batch: pa.RecordBatch, as_text: bool) -> list[pa.Array]:
    data, offsets = text_buffer(batch.column(1))
    size, out, kept = np.diff(offsets), [], []
    column = batch.column(2)
    ends = column.offsets.to_numpy()
    start, end = (column.values.field(k).to_numpy() for k in range(2))
    for i in range(batch.num_rows):
        own = slice(int(ends[i]), int(ends[i + 1]))
        united = unite(start[own], end[own]) if own.stop > own.start else []
        out.append([{"start": a, "end": b} for a, b in united])
        text, at, parts = data[offsets[i] : offsets[i + 1]], 0, []
        for a, b in united:
            parts.append(text[at:a])
            at = b
        parts.append(text[at:])
        kept.append(b"".join(p.tobytes() for p in parts))
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    if as_text:
        left = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
    else:
        left = pa.array(kept, pa.binary())
    return [batch.column(0), pa.array(size, pa.int64()), pa.array(out, pairs), left]


def unite(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching spans as maximal ones."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    fresh = np.ones(len(start), bool)
    fresh[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(start)) - 1
    return [(int(a), int(b)) for a, b in zip(start[first], end[last])]
