"""Exact set-similarity join of documents on word shingles.

Documents with equal sets form a class.  Two classes of similarity 4/5 or more share one of the
first ``n - ceil(4n/5) + 1`` shingles of each in any fixed order of all shingles.  The order here is
rarest first (by a counting sketch of fixed size over all documents, ties by hash), so passages that
many documents share come last and tiles stay small.

More is asked of each class before it takes part: with a prefix longer by ``n // 5`` shingles, two
linked classes share more than ``4 n // 25`` of them, so a class with fewer shared ones has no link.
Shingles that meet by chance, of which a larger corpus has more, are thereby left out.

A *tile* holds the classes of one size band that share such a shingle.  Each class carries a bitmap
signature: bit ``h mod width`` is the parity of the shingles hashed there.  Every bit in which two
signatures differ is a shingle that only one of the sets has, so the number of differing bits bounds
the overlap from above; pairs that cannot reach the threshold go.  What is left is decided by
intersecting the sorted shingle arrays.

Near copies make tiles in which all pairs are similar.  These are not written out: first each class
is only compared with the smallest class of its tiles, and the links found join classes into
components.  Then pairs of different components are compared, tile by tile, in blocks of bounded
size; of those that may link a task passes on a spanning forest of the closest, until that joins
nothing more.  At last all pairs still between different components are decided.  No link between
different components can be lost, no pair within one is needed.

Shingles and set digests are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docsignal.llm.common import (
    PrefixHash, ascii_lower, key_back, key_bitmap, key_column, map_batches, materialize, maybe_in,
    mix, text_buffer, text_slices, word_spans,
)
from docsignal.llm.components import components

WORDS = 5
SKETCH_BITS, SKETCH_BLOCK = 20, 4096
BLOCK = 2048  # classes of a tile compared in one task
MEMBERS = 2000  # texts verified against one class in one task

FOREST_TILES = 6
FOREST_PAIRS = 1 << 20  # pairs held by a task before they are thinned to a forest

PASS_SCHEMA = "doc_id long, cls long, n long, block int, counts binary"


# ---- shingles -----------------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray, hasher: PrefixHash) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a slice of texts."""
    start, end, row = word_spans(data, offsets)
    words = mix(hasher.span(hasher.sums(ascii_lower(data)), start, end))
    base = np.uint64(0xD6E8FEB86659FD93)
    whole = np.zeros(0, np.uint64)
    if len(words) >= WORDS:
        whole = words[: len(words) - WORDS + 1].copy()
        for k in range(1, WORDS):
            whole = whole * base + words[k : len(words) - WORDS + 1 + k]
        whole = mix(whole)
    first = np.searchsorted(row, np.arange(len(offsets)))
    sets = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= WORDS:
            own = np.sort(whole[a : b - WORDS + 1])
            fresh = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            sets.append(own[fresh])
        elif b > a:  # too short for a shingle: the whole sequence is one
            value = np.full(1, b - a, np.uint64)
            for word in words[a:b]:
                value = value * base + word
            sets.append(mix(mix(value)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_digest(own: np.ndarray) -> int:
    """A 64-bit digest of a set, as a signed number."""
    total = mix(own ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    return int(mix(np.array([total], np.uint64) + np.uint64(len(own)))[0].astype(np.int64))


def signature_width(n: int) -> int:
    """Bits of the signature of a set of ``n``: a power of two of at least 4n and 64."""
    return max(64, 1 << (4 * n - 1).bit_length())


def signature(own: np.ndarray) -> np.ndarray:
    """Parity of the set's shingles by ``hash mod width``, packed into 64-bit words."""
    width = signature_width(len(own))
    odd = np.bincount((own & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def prefix_length(n: int) -> int:
    """Length of the prefix in which linked sets share more than ``4 n // 25`` shingles."""
    return n - (4 * n + 4) // 5 + 1 + n // 5 if n else 0


def fold(words: np.ndarray, to: int) -> np.ndarray:
    """Signatures (rows of words) folded to ``to`` words; stays a parity signature."""
    while words.shape[1] > to:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def may_link(a: np.ndarray, b: np.ndarray, differing: np.ndarray) -> np.ndarray:
    """Whether sets of sizes ``a`` and ``b`` can reach the threshold, by their signatures."""
    most = np.minimum((a + b - differing) // 2, np.minimum(a, b))
    return links(a, b, most)


def links(a, b, common):
    return 100 * common >= 80 * (a + b - common)


# ---- passes over the texts ----------------------------------------------------------------------


def _sets_of_batch(batch: pa.RecordBatch, hasher: PrefixHash) -> Iterator[tuple[int, np.ndarray]]:
    for i, _, data, offsets in text_slices(*text_buffer(batch.column(1))):
        for n, own in enumerate(shingle_sets(data, offsets, hasher)):
            yield i + n, own


def summarise(docs: DataFrame) -> DataFrame:
    """One pass: a row per document (class, size), and the task's part of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PrefixHash()
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            cls, sizes, held = [], [], []
            for _, own in _sets_of_batch(batch, hasher):
                cls.append(set_digest(own))
                sizes.append(len(own))
                held.append((own & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int32))
            if held:
                counts += np.bincount(np.concatenate(held), minlength=1 << SKETCH_BITS)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cls, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                names=PASS_NAMES,
            )
        parts = [
            (k, _pack_counts(part))
            for k, part in enumerate(counts.reshape(-1, SKETCH_BLOCK))
            if part.any()
        ]
        if parts:
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(n, pa.int64())] * 3, pa.array([k for k, _ in parts], pa.int32()),
                 pa.array([c for _, c in parts], pa.binary())],
                names=PASS_NAMES,
            )

    return map_batches(docs.select("doc_id", "text"), run, PASS_SCHEMA)


PASS_NAMES = ["doc_id", "cls", "n", "block", "counts"]


def _pack_counts(part: np.ndarray) -> bytes:
    """Counts of a block, as (place, count) pairs where that is shorter."""
    at = np.flatnonzero(part)
    if 2 * len(at) < len(part):
        return np.stack([at, part[at]]).astype(np.uint32).tobytes()
    return part.astype(np.uint32).tobytes()


def _unpack_counts(data: bytes) -> np.ndarray:
    found = np.frombuffer(data, np.uint32)
    if len(found) == SKETCH_BLOCK:
        return found.astype(np.int64)
    part = np.zeros(SKETCH_BLOCK, np.int64)
    at, n = found.reshape(2, -1)
    part[at] = n
    return part


def sketch_of(summary: DataFrame) -> np.ndarray:
    """How many documents have a shingle in each of 2**SKETCH_BITS buckets (fixed size)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(*(c.to_pylist() for c in batch.columns)):
                part = _unpack_counts(data)
                sums[block] = sums[block] + part if block in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["block", "counts"],
        )

    parts = summary.where("block is not null").select("block", "counts").repartition("block")
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    found = map_batches(parts, add, "block int, counts binary").toArrow()  # 8 MB at most
    for block, counts in zip(found["block"].to_pylist(), found["counts"].to_pylist()):
        at = block * SKETCH_BLOCK
        total[at : at + SKETCH_BLOCK] = np.frombuffer(counts, np.int64)
    return np.minimum(total, (1 << 32) - 1).astype(np.uint32)


def postings(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``(token, cls, n)``: the rarest-first prefix of every set; a class once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts, seen = PrefixHash(), shared.value, set()
        mask = np.uint64(len(counts) - 1)
        for batch in batches:
            tokens, classes, sizes, lengths = [], [], [], []
            for _, own in _sets_of_batch(batch, hasher):
                cls = set_digest(own)
                if not len(own) or cls in seen:
                    continue
                seen.add(cls)
                order = np.argsort(counts[own & mask], kind="stable")
                tokens.append(own[order[: prefix_length(len(own))]])
                classes.append(cls)
                sizes.append(len(own))
                lengths.append(len(tokens[-1]))
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat.view(np.int64)),
                 pa.array(np.repeat(np.array(classes, np.int64), lengths)),
                 pa.array(np.repeat(np.array(sizes, np.int64), lengths))],
                names=["token", "cls", "n"],
            )

    return map_batches(docs.select("doc_id", "text"), run, "token long, cls long, n long")


def shared_only(found: DataFrame) -> DataFrame:
    """The postings of tokens that more than one class has, each once.

    One shuffle by token; each task streams through its sorted rows and holds one row back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # last row so far: (token, cls, n, already known to be shared)
        for batch in batches:
            if not batch.num_rows:
                continue
            token, cls, n = (c.to_numpy() for c in batch.columns)
            shared_before = False
            if kept is not None:
                token, cls, n = (np.append([v], c) for v, c in zip(kept[:3], (token, cls, n)))
                shared_before = kept[3]
            fresh = np.ones(len(token), bool)
            fresh[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
            token, cls, n = token[fresh], cls[fresh], n[fresh]
            same = np.zeros(len(token) + 1, bool)
            same[1:-1] = token[1:] == token[:-1]
            many = same[:-1] | same[1:]
            many[0] |= shared_before
            kept = (token[-1], cls[-1], n[-1], bool(many[-1]))
            out = many.copy()
            out[-1] = False
            yield _tile_rows(token[out], cls[out], n[out])
        if kept is not None and kept[3]:
            yield _tile_rows(*(np.array([v]) for v in kept[:3]))

    rows = found.repartition("token").sortWithinPartitions("token", "cls")
    return map_batches(rows, run, "token long, cls long, n long")


def _tile_rows(token, cls, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(c, np.int64)) for c in (token, cls, n)], names=["token", "cls", "n"]
    )


def enough_shared(tiles: DataFrame) -> DataFrame:
    """The tile rows of the classes that share enough of their prefix to have a link at all.

    Asked twice: shingles shared only with classes that went the first time count no more.
    """
    for again in (False, True):
        if again:
            tokens = tiles.groupBy("token").agg(F.count("*").alias("members"))
            tiles = tiles.join(tokens.where("members > 1").select("token"), "token")
        counts = tiles.groupBy("cls").agg(F.count("*").alias("shared"), F.first("n").alias("size"))
        able = counts.where("shared > cast(floor(4 * size / 25) as long)").select("cls")
        tiles = materialize(tiles.join(able, "cls").select("token", "cls", "n"), "jaccard-tiles")
    return tiles


def some_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of the rows whose key may be in ``ids.doc_id`` (an exact join follows)."""
    bitmap = docs.sparkSession.sparkContext.broadcast(
        key_bitmap(ids.select(F.xxhash64("doc_id").alias("h")), "h")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take = pa.array(maybe_in(bitmap.value, batch.column(2).to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(take), batch.column(1).filter(take)], names=["doc_id", "text"]
            )

    hashed = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h"))
    return map_batches(hashed, run, "doc_id long, text string")


def signatures(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """``(cls, bits)`` of the classes in ``reps(cls, rep)``, from the text of their first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PrefixHash()
        for batch in batches:
            cls, bits = [], []
            for _, own in _sets_of_batch(batch, hasher):
                cls.append(set_digest(own))
                bits.append(signature(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls, pa.int64()), pa.array(bits, pa.binary())], names=["cls", "bits"]
            )

    texts = some_texts(docs, reps.select(F.col("rep").alias("doc_id")))
    found = map_batches(texts, run, "cls long, bits binary").join(reps.select("cls"), "cls")
    return found.dropDuplicates(["cls"])


# ---- pairs --------------------------------------------------------------------------------------


def band(n: str = "n") -> F.Column:
    """Sizes of one band differ by less than 5/4, so no size within it rules a pair out."""
    return F.floor(F.log(F.col(n)) / F.log(F.lit(1.25))).cast("int")


def star_pairs(tiles: DataFrame) -> DataFrame:
    """Each class with the smallest class of each of its tiles (token and band)."""
    banded = tiles.withColumn("band", band())
    least = banded.groupBy("token", "band").agg(
        F.min(F.struct("cls", "n")).alias("m"), F.count("*").alias("members")
    )
    rows = banded.join(least.where("members > 1"), ["token", "band"]).where("cls != m.cls")
    return rows.select(
        F.col("m.cls").alias("a"), F.col("cls").alias("b"), F.col("m.n").alias("na"),
        F.col("n").alias("nb"),
    ).distinct()


def signed(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs whose signatures ``(cls, bits)`` allow a link."""
    rows = pairs.join(bits.toDF("a", "bits_a"), "a").join(bits.toDF("b", "bits_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            pair = np.arange(len(na))
            differing = differing_bits(_Signatures(batch.column(4)), pair, _Signatures(batch.column(5)), pair)
            take = pa.array(may_link(na, nb, differing))
            yield pa.RecordBatch.from_arrays(
                [c.filter(take) for c in batch.columns[:4]], names=["a", "b", "na", "nb"]
            )

    schema = "a long, b long, na long, nb long"
    return map_batches(rows.select("a", "b", "na", "nb", "bits_a", "bits_b"), run, schema)


class _Signatures:
    """A column of signatures as flat words."""

    def __init__(self, column: pa.Array) -> None:
        data, offsets = text_buffer(column)
        self.words = np.frombuffer(np.ascontiguousarray(data).tobytes(), np.uint64)
        self.first = offsets[:-1] // 8
        self.size = np.diff(offsets) // 8


def differing_bits(a: _Signatures, i: np.ndarray, b: _Signatures, j: np.ndarray) -> np.ndarray:
    """Bits in which the signatures ``a[i]`` and ``b[j]`` differ, at the narrower width."""
    out = np.zeros(len(i), np.int64)
    wa, wb = a.size[i], b.size[j]
    for one, two in {(int(x), int(y)) for x, y in np.unique(np.stack([wa, wb], 1), axis=0)} if len(i) else ():
        own = np.flatnonzero((wa == one) & (wb == two))
        to, step = min(one, two), max(1, (1 << 19) // max(one, two))
        for at in range(0, len(own), step):
            part = own[at : at + step]
            left = a.words[a.first[i[part]][:, None] + np.arange(one)]
            right = b.words[b.first[j[part]][:, None] + np.arange(two)]
            out[part] = np.bitwise_count(fold(left, to) ^ fold(right, to)).sum(axis=1)
    return out


def cross_pairs(tiles: DataFrame, bits: DataFrame, comps: DataFrame, forest: bool) -> DataFrame:
    """Pairs of classes of one token but of different components that may link.

    With ``forest`` a task returns only as many of the closest as join what they can join, and each
    class is looked at in ``FOREST_TILES`` of its tiles (those of least hash, so like sets meet);
    that only helps, since a pass over all tiles without ``forest`` follows.  A tile of more than ``BLOCK`` classes is cut into blocks; each task compares two blocks, so no
    tile has to fit into one task.
    """
    if forest:
        least = Window.partitionBy("cls").orderBy(F.xxhash64("token"), "token")
        tiles = tiles.withColumn("at", F.row_number().over(least)).where(F.col("at") <= FOREST_TILES)
    rows = tiles.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "comp", F.coalesce("component", "cls")
    )
    tokens = rows.groupBy("token").agg(
        F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("members")
    )
    tokens = tokens.where("c0 != c1").withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK).cast("int")
    )
    rows = rows.select("token", "cls", "n", "comp").join(tokens.select("token", "blocks"), "token")
    rows = rows.join(bits, "cls")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    rows = rows.withColumns(
        {"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}
    ).select("token", "lo", "hi", "own", "n", "cls", "comp", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            if waiting is not None:
                batch = pa.concat_batches([waiting, batch])
            key = [batch.column(k).to_numpy() for k in range(3)]
            change = np.zeros(batch.num_rows, bool)
            for k in key:
                change[1:] |= k[1:] != k[:-1]
            cut = int(np.flatnonzero(change)[-1]) if change.any() else 0
            waiting = batch.slice(cut)
            if cut:
                yield _compare(batch.slice(0, cut), forest)
        if waiting is not None and waiting.num_rows:
            yield _compare(waiting, forest)

    dealt = rows.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "n", "cls")
    return map_batches(dealt, run, "a long, b long, na long, nb long").distinct()


def _compare(batch: pa.RecordBatch, forest: bool) -> pa.RecordBatch:
    """Pairs within runs of equal (token, lo, hi), rows sorted by size; each pair of blocks once."""
    token, lo, hi, own, n, cls, comp = (batch.column(k).to_numpy() for k in range(7))
    bits = _Signatures(batch.column(7))
    run = np.zeros(len(token), np.int64)
    run[1:] = np.cumsum((token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))
    comp = np.unique(comp, return_inverse=True)[1]
    found, held = [], 0
    left, step = np.arange(len(token)), 0
    while len(left):
        step += 1
        left = left[left + step < len(token)]
        right = left + step
        near = (run[left] == run[right]) & (5 * n[left] >= 4 * n[right])
        left = left[near]
        right = left + step
        ask = (comp[left] != comp[right]) & ((lo[left] == hi[left]) | (own[left] != own[right]))
        i, j = left[ask], right[ask]
        if len(i):
            differing = differing_bits(bits, i, bits, j)
            ok = may_link(n[i], n[j], differing)
            i, j, differing = i[ok], j[ok], differing[ok]
            found.append((i, j, differing / (n[i] + n[j])))
            held += len(i)
        if forest and held > FOREST_PAIRS:
            found = [_forest(*(np.concatenate(c) for c in zip(*found)), comp)]
            held = len(found[0][0])
    if found:
        i, j, far = (np.concatenate(c) for c in zip(*found))
        if forest:
            i, j, far = _forest(i, j, far, comp)
    else:
        i = j = np.zeros(0, np.int64)
    swap = cls[i] > cls[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in (cls[i], cls[j], n[i], n[j])], names=["a", "b", "na", "nb"]
    )


def _forest(i: np.ndarray, j: np.ndarray, far: np.ndarray, comp: np.ndarray):
    """Of pairs ``(i, j)`` at distances ``far`` a spanning forest of the closest over ``comp``."""
    label = np.arange(comp.max() + 1)
    rank = np.argsort(np.argsort(far, kind="stable"), kind="stable")  # no two distances are equal
    taken = np.zeros(len(i), bool)
    while True:
        a, b = label[comp[i]], label[comp[j]]
        open_ = np.flatnonzero(a != b)
        if not len(open_):
            return i[taken], j[taken], far[taken]
        best = np.full(len(label), len(i))
        np.minimum.at(best, a[open_], rank[open_])
        np.minimum.at(best, b[open_], rank[open_])
        pick = open_[(best[a[open_]] == rank[open_]) | (best[b[open_]] == rank[open_])]
        taken[pick] = True
        while True:  # the picked pairs join their components: least labels until nothing changes
            least = np.minimum(label[comp[i[pick]]], label[comp[j[pick]]])
            before = label.copy()
            np.minimum.at(label, before[comp[i[pick]]], least)
            np.minimum.at(label, before[comp[j[pick]]], least)
            label = label[label]
            if (label == before).all():
                break


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``(a, b, common)`` that do link, by intersecting their sorted shingle arrays.

    Texts of the classes concerned are sent to the pair's first class; one with more than
    ``MEMBERS`` partners is dealt over several tasks, each with a copy of that one text.
    """
    pairs = pairs.select("a", "b")
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    first = classes.join(wanted, "cls").select(F.col("cls").alias("b"), F.col("rep").alias("doc_id"))
    tasks = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("tasks"))
    each = F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int").alias("part")
    dealt = pairs.join(tasks, "a").select("a", "b", each)
    heads = tasks.select(
        "a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("part")
    )
    wanted_ids = materialize(dealt.union(heads).join(first, "b"), "jaccard-pairs")
    texts = some_texts(docs, wanted_ids)
    rows = wanted_ids.join(texts, "doc_id").select("a", "part", (F.col("a") != F.col("b")).alias("member"), "b", "text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, head, own_head = PrefixHash(), None, np.zeros(0, np.uint64)
        for batch in batches:
            a, part, member, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            out = []
            texts = pa.RecordBatch.from_arrays([batch.column(0), batch.column(4)], names=["k", "t"])
            for i, own in _sets_of_batch(texts, hasher):
                if not member[i]:
                    if head != (a[i], part[i]) or set_digest(own) == a[i]:
                        head, own_head = (a[i], part[i]), own
                    continue
                if set_digest(own) != b[i]:  # another text under the same key
                    continue
                common = len(np.intersect1d(own_head, own, assume_unique=True))
                if head == (a[i], part[i]) and links(len(own_head), len(own), common):
                    out.append((a[i], b[i], common))
            columns = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(c, np.int64)) for c in columns], names=["a", "b", "common"]
            )

    dealt = rows.repartition("a", "part").sortWithinPartitions("a", "part", "member")
    return map_batches(dealt, check, "a long, b long, common long")


# ---- the operator -------------------------------------------------------------------------------


def similarity_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    A set holds the distinct five-word shingles of the whole text after lower-casing A-Z; a text of
    fewer words is one shingle.  Sets link when 100 * common >= 80 * union.  ``component_id`` is the
    smallest key reachable by links.

    NULL, empty and wordless texts have 0 shingles, link with nothing and are their own component.
    A NULL key is smaller than any other.  Repeated rows are equal sets; rows that repeat a key with
    other texts are documents of their own.  Other columns are ignored; an empty table gives no
    rows.
    """
    docs = docs.select(key_column(key).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    summary = materialize(summarise(docs), "jaccard-summary")
    thin = summary.where("block is null").select("doc_id", "cls", "n")
    classes = materialize(
        thin.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")),
        "jaccard-classes",
    )
    tiles = materialize(shared_only(postings(docs, sketch_of(summary))), "jaccard-shared")
    tiles = enough_shared(tiles)
    bits = materialize(
        signatures(docs, tiles.select("cls").distinct().join(classes, "cls")), "jaccard-signatures"
    )

    def decide(pairs: DataFrame) -> DataFrame:
        return materialize(verified(pairs, docs, classes), "jaccard-links")

    tested = materialize(signed(star_pairs(tiles), bits), "jaccard-star")
    links = decide(tested)
    comps = materialize(components(links), "jaccard-components")
    forest = True
    while True:
        pairs = cross_pairs(tiles, bits, comps, forest).join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "jaccard-cross")
        more = decide(pairs) if not pairs.isEmpty() else None
        joins = more is not None and not more.isEmpty()
        if joins:
            links = links.select("a", "b").union(more.select("a", "b"))
            comps = materialize(components(links), "jaccard-components")
        if not forest:
            break
        tested = tested.select("a", "b").union(pairs.select("a", "b"))
        forest = joins  # when a forest joins nothing more, all pairs are asked
    reps = classes.join(comps.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "rep", F.coalesce("component", "cls").alias("comp")
    )
    least = reps.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = reps.join(least, "comp").select("cls", "component_id")
    rows = thin.select("doc_id", "cls", F.col("n").alias("n_shingles"))
    linked = rows.where("n_shingles > 0").join(named, "cls")
    alone = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    out = linked.select("doc_id", "n_shingles", "component_id").union(
        alone.select("doc_id", "n_shingles", "component_id")
    )
    return out.withColumns({c: key_back(c) for c in ("doc_id", "component_id")})
