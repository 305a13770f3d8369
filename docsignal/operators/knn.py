"""Exact k-nearest-neighbour distances of every row to the other rows of its group.

Rows are assigned to the nearest of a few thousand pivots; a cell is the unit of work and is split
by key hash when it is large, so neither a hot region nor a mass of copies lands in one task.

Round 1 finds neighbours inside a row's own chunk, which bounds its k-th distance from above.
Round 2 ships the row only to those cells that the triangle inequality cannot rule out, again in
bounded pieces.  Each comparison of two chunks keeps the k best per row; no pair table is built.
How many cells survive the bound depends on the data: for clustered rows a few, for structureless
high-dimensional rows nearly all of them.  The surviving (row, chunk) lines are therefore counted
before any is shipped.  Where comparing every two of a few large blocks is cheaper, that is done
instead: the work is then quadratic, but a row is shipped once per block and not once per cell.
Both ways are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from docsignal.operators.matrix import to_lists, to_matrix
from docsignal.session import discard, materialize, no_shuffles_left

CHUNK_ROWS = 4096
MAX_PIVOTS = 4096  # beyond chunk_rows times this many rows, cells are split by key hash instead
BLOCK_ROWS = 256
TILE_ROWS = 4096
HALF_ROWS = 1024  # of a block searched by halves, at least
COARSE_ROWS = 64  # of one block, compared by 16-bit numbers with a tile of the other
TILE_CELLS = 1 << 22  # distances held at once by a search in one block
SPARE = 8  # candidates kept beyond k before exact distances decide
SHIP_BYTES = 16 << 20  # of rows in one batch on their way to other chunks
SIDE_BYTES = 64 << 20  # of one block's rows, where blocks are compared
AT_ONCE = 8  # blocks that are compared in one pass; of more, each meets few others in a pass
BLOCK_PAIRS = 32  # wanted for the cores to share, as long as a block has CHUNK_ROWS rows


def pairwise(a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """Minkowski distances, rows of ``a`` by rows of ``b`` (p = 2 through one matrix product)."""
    if p == 2:
        sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
        return np.sqrt(np.maximum(sq, 0.0))
    out = np.zeros((len(a), len(b)))
    columns = np.ascontiguousarray(b.T)
    for lo in range(0, len(a), 16):  # few rows, so that both buffers stay in the cache
        rows, sums = a[lo : lo + 16], out[lo : lo + 16]
        gap = np.empty_like(sums)
        for j, column in enumerate(columns):
            np.subtract(rows[:, j, None], column, out=gap)
            np.abs(gap, out=gap)
            sums += gap if p == 1 else gap**p
    return out if p == 1 else out ** (1.0 / p)


class _Coarse:
    """Lower bounds of Manhattan distances between the rows of two blocks, from 16-bit numbers.

    Values become whole steps, ``levels`` of them between ``low`` and the highest; what lies outside
    counts as the nearer end.  A row's ``off`` is how far its steps are from its values in all, so
    no distance is below steps between two rows less what both are off.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        width = max(1, a.shape[1])
        self.levels = np.iinfo(np.int16).max // width  # sums over a row stay within 16 bits
        sample = np.concatenate([x[:: max(1, len(x) // 1024)].ravel() for x in (a, b)])
        sample = sample[np.isfinite(sample)]
        self.low, high = np.quantile(sample, [0.001, 0.999]) if len(sample) else (0.0, 1.0)
        self.step = (high - self.low) / max(1, self.levels)
        self.useful = self.levels >= 64 and self.step > 0 and np.isfinite(1.0 / self.step)
        if self.useful:
            (self.a, self.off_a), (self.b, self.off_b) = self._rounded(a), self._rounded(b)
            self.b = np.ascontiguousarray(self.b.T)

    def _rounded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps, off = np.empty(x.shape, np.int16), np.empty(len(x), np.int32)
        for lo in range(0, len(x), TILE_ROWS):  # buffers as large as the block would not do
            at = slice(lo, lo + TILE_ROWS)
            scaled = np.clip((np.nan_to_num(x[at]) - self.low) / self.step, 0, self.levels)
            steps[at] = np.rint(scaled)
            off[at] = np.ceil(np.abs(scaled - steps[at]).sum(1))
        return steps, off

    def limits(self, reach: np.ndarray) -> np.ndarray:
        """Reaches in steps, with room for the rounding of the sums that follow."""
        return np.minimum(reach / self.step * (1 + 1e-9) + 2, 1 << 29).astype(np.int32)

    def maybe(self, i: slice, j: slice, limit_a: np.ndarray, limit_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows ``i`` of a and ``j`` of b that may be within the limit of one of them."""
        rows, others = self.a[i], self.b[:, j]
        at, to = [], []
        for lo in range(0, len(rows), COARSE_ROWS):
            part = rows[lo : lo + COARSE_ROWS]
            sums = np.zeros((len(part), others.shape[1]), np.int16)
            gap = np.empty_like(sums)
            for column, other in zip(part.T, others):
                np.subtract(column[:, None], other, out=gap)
                np.abs(gap, out=gap)
                sums += gap
            mine = slice(i.start + lo, i.start + lo + len(part))
            least = sums - self.off_a[mine, None] - self.off_b[j]
            near = np.nonzero(least <= np.maximum(limit_a[mine, None], limit_b[j]))
            at.append(near[0] + lo)
            to.append(near[1])
        return np.concatenate(at), np.concatenate(to)


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of pairs of rows, added up column by column as ``pairwise`` does."""
    out = np.zeros(len(a))
    for x, y in zip(a.T, b.T):
        out += np.abs(x - y)
    return out


def nearest(a: np.ndarray, b: np.ndarray, k: int, p: float, same: bool) -> np.ndarray:
    """Sorted distances from each row of ``a`` to its ``k`` nearest rows of ``b``.

    ``same`` says that ``b`` is ``a`` and a row is not its own neighbour.  For p = 2 a matrix
    product preselects candidates; the distances returned come from exact differences, and rows
    whose preselection could have missed a neighbour are redone over every possible candidate.
    """
    available = len(b) - int(same)
    k = min(k, available)
    if k <= 0 or not len(a):
        return np.zeros((len(a), 0))
    centre = b.mean(0)
    b = b - centre
    a = b if same else a - centre
    b_sq = (b * b).sum(1)
    out = np.empty((len(a), k))
    step = max(1, min(BLOCK_ROWS, TILE_CELLS // len(b)))
    for start in range(0, len(a), step):
        rows = a[start : start + step]
        own = np.arange(start, start + len(rows))
        if p != 2:
            d = pairwise(rows, b, p)
            if same:
                d[np.arange(len(rows)), own] = np.inf
            out[own] = np.sort(np.partition(d, k - 1, axis=1)[:, :k], axis=1)
            continue
        approx = (rows * rows).sum(1)[:, None] + b_sq[None, :] - 2.0 * (rows @ b.T)
        if same:
            approx[np.arange(len(rows)), own] = np.inf
        m = min(len(b), k + SPARE)
        picks = np.argpartition(approx, m - 1, axis=1)[:, :m]
        exact = ((b[picks] - rows[:, None, :]) ** 2).sum(2)
        if same:
            exact[picks == own[:, None]] = np.inf
        best = np.sort(exact, axis=1)[:, :k]
        if m < len(b):
            slack = 1e-10 * ((rows * rows).sum(1) + b_sq.max())
            edge = np.take_along_axis(approx, picks, 1).max(1)
            for i in np.nonzero((edge - slack <= best[:, -1]) & (best[:, -1] > 0))[0]:
                wide = np.nonzero(approx[i] <= best[i, -1] + slack[i])[0]
                redo = ((b[wide] - rows[i]) ** 2).sum(1)
                redo[~np.isfinite(approx[i, wide])] = np.inf
                best[i] = np.sort(redo)[:k]
        out[own] = np.sqrt(best)
    return out


def nearer_pairs(
    a: np.ndarray, b: np.ndarray, reach_a: np.ndarray, reach_b: np.ndarray, k: int, p: float
) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Two blocks compared once: ``(row, distance)`` for the rows of ``a``, and for those of ``b``.

    Per row its at most ``k`` nearest rows of the other block below its reach, ordered by row and
    distance.  For p = 2 a matrix product finds the pairs whose exact distance is looked at, for
    p = 1 16-bit differences do; where these leave many pairs, all are computed.
    """
    coarse = _Coarse(a, b) if p == 1 and len(a) and len(b) else None
    centre = b.mean(0)
    a, b = a - centre, b - centre
    # No distance is below 0: a row with k copies looks for nothing.
    if p == 2:
        a_sq, b_sq = (a * a).sum(1), (b * b).sum(1)
        slack = 1e-10 * (a_sq.max() + b_sq.max())
        limit_a = np.where(reach_a > 0, reach_a**2 + slack, -np.inf)
        limit_b = np.where(reach_b > 0, reach_b**2 + slack, -np.inf)
    elif coarse is not None and coarse.useful:
        limit_a = np.where(reach_a > 0, coarse.limits(reach_a), -(1 << 29))
        limit_b = np.where(reach_b > 0, coarse.limits(reach_b), -(1 << 29))
    pairs = max(1, SHIP_BYTES // (8 * max(1, a.shape[1])))
    near_a, near_b = _Nearest(k), _Nearest(k)
    for i in range(0, len(a), BLOCK_ROWS):
        rows = a[i : i + BLOCK_ROWS]
        for j in range(0, len(b), TILE_ROWS):
            others = b[j : j + TILE_ROWS]
            if p == 2:
                lim_a, lim_b = limit_a[i : i + len(rows), None], limit_b[j : j + len(others)]
                d = a_sq[i : i + len(rows), None] + b_sq[j : j + len(others)] - 2.0 * (rows @ others.T)
                at, to = np.nonzero((d <= lim_a) | (d <= lim_b))
                exact = np.empty(len(at))
                for lo in range(0, len(at), pairs):
                    part = slice(lo, lo + pairs)
                    exact[part] = np.sqrt(((others[to[part]] - rows[at[part]]) ** 2).sum(1))
            else:
                at = None
                if coarse is not None and coarse.useful:
                    at, to = coarse.maybe(slice(i, i + len(rows)), slice(j, j + len(others)), limit_a, limit_b)
                if at is not None and len(at) <= rows.shape[0] * len(others) // 16:
                    exact = np.empty(len(at))
                    for lo in range(0, len(at), pairs):
                        part = slice(lo, lo + pairs)
                        exact[part] = _manhattan(rows[at[part]], others[to[part]])
                else:
                    d = pairwise(rows, others, p)
                    at, to = np.nonzero((d < reach_a[i : i + len(rows), None]) | (d < reach_b[j : j + len(others)]))
                    exact = d[at, to]
            at, to = at + i, to + j
            for found, who, reach in ((near_a, at, reach_a), (near_b, to, reach_b)):
                below = exact < reach[who]
                found.add(who[below], exact[below])
    return near_a.best(), near_b.best()


class _Nearest:
    """The k smallest distances per row, gathered in portions."""

    def __init__(self, k: int):
        self.k, self.parts, self.waiting, self.kept = k, [], 0, 0

    def add(self, who: np.ndarray, distance: np.ndarray) -> None:
        self.parts.append((who, distance))
        self.waiting += len(who)
        if self.waiting > self.kept + (1 << 20):
            self.parts = [self.best()]
            self.kept = self.waiting = len(self.parts[0][0])

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, int), np.zeros(0)
        who = np.concatenate([w for w, _ in self.parts])
        distance = np.concatenate([d for _, d in self.parts])
        order = np.lexsort((distance, who))
        who, distance = who[order], distance[order]
        starts = np.flatnonzero(np.diff(who, prepend=-1))
        rank = np.arange(len(who)) - np.repeat(starts, np.diff(starts, append=len(who)))
        return who[rank < self.k], distance[rank < self.k]


def nearest_pivot(x: np.ndarray, pivots: np.ndarray, p: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row the pivot next to it, and how far that is; a few rows at a time."""
    cell = np.zeros(len(x), dtype=np.int32)
    for lo in range(0, len(x), BLOCK_ROWS):
        cell[lo : lo + BLOCK_ROWS] = pairwise(x[lo : lo + BLOCK_ROWS], pivots, p).argmin(1)
    return cell, (np.abs(x - pivots[cell]) ** p).sum(1) ** (1.0 / p)


@dataclass
class _Cells:
    """Pivots of one group and what is known about their cells."""

    pivots: np.ndarray
    n: int
    inner: np.ndarray  # smallest distance of a member to its pivot
    outer: np.ndarray  # largest
    chunks: np.ndarray
    members: np.ndarray

    def reach(self, x: np.ndarray, wanted: int, p: float) -> np.ndarray:
        """Above the distance of each row to its ``wanted``-th neighbour, from cells alone."""
        far = pairwise(x, self.pivots, p) + self.outer
        order = np.argsort(far, axis=1)
        enough = (np.cumsum(self.members[order], axis=1) > wanted).argmax(1)  # the row counts too
        at = order[np.arange(len(x)), enough]
        size = np.sqrt((x * x).sum(1)) + np.sqrt((self.pivots[at] ** 2).sum(1))
        return far[np.arange(len(x)), at] + 1e-7 * size + 1e-300

    def lower_bounds(self, x: np.ndarray, own: np.ndarray, p: float) -> np.ndarray:
        """For each row and cell: no member of the cell can be nearer than this."""
        to_pivot = pairwise(x, self.pivots, p)
        mine = to_pivot[np.arange(len(x)), own][:, None]
        bound = np.maximum(to_pivot - self.outer, self.inner - to_pivot)
        if p == 2:
            between = pairwise(self.pivots[own], self.pivots, 2)
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (to_pivot**2 - mine**2) / (2.0 * between)
            bound = np.maximum(bound, np.where(between > 0, plane, -np.inf))
        else:
            bound = np.maximum(bound, (to_pivot - mine) / 2.0)
        size = np.sqrt((x * x).sum(1))[:, None] + np.sqrt((self.pivots**2).sum(1))[None, :]
        bound = np.maximum(bound - 1e-7 * size, 0.0)
        bound[np.arange(len(x)), own] = 0.0
        bound[:, self.chunks == 0] = np.inf
        return bound


def _pick_pivots(rows: DataFrame, counts: dict[int, int], chunk_rows: int) -> dict[int, np.ndarray]:
    """A hash-chosen handful of rows per group; the choice affects speed, never results."""
    wanted = {g: int(min(MAX_PIVOTS, -(-n // chunk_rows))) for g, n in counts.items()}
    draw = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("double")
    share = F.lit(0.0)
    for g, n in counts.items():
        share = F.when(F.col("grp") == g, (2.0 * wanted[g] + 32.0) / n).otherwise(share)
    rows_found = rows.where(draw < share * float(2**32)).select("grp", draw.alias("h"), "id", "x")
    found: dict[int, list] = {g: [] for g in counts}
    for r in rows_found.orderBy("grp", "h", "id").collect():
        if len(found[r.grp]) < wanted[r.grp]:
            found[r.grp].append(r.x)
    for g, picked in found.items():
        if not picked:
            picked.append(rows.where(F.col("grp") == g).first().x)
    return {g: np.unique(np.array(v, dtype=np.float64), axis=0) for g, v in found.items()}


def knn_distances(
    df: DataFrame,
    k: int,
    key: str = "doc_id",
    features: str = "features",
    p: float = 2.0,
    group: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(key[, group], distances)``: ascending distances to the ``min(k, n - 1)`` nearest rows."""
    if p < 1:
        raise ValueError("Minkowski distances need p >= 1")
    rows = df.select(
        F.col(key).alias("id"),
        (F.col(group).cast("int") if group else F.lit(0)).alias("grp"),
        F.col(features).cast("array<double>").alias("x"),
    )
    counts = {r.grp: r.n for r in rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    id_type = rows.schema["id"].dataType.simpleString()
    lists = _in_cells(rows, counts, k, p, chunk_rows, id_type)
    keys = [F.col("id").alias(key)] + ([F.col("grp").alias(group)] if group else [])
    # A row's lists, each of k distances at most, meet in one group.
    return _best_of(lists, k).select(*keys, "distances")


def _best_of(lists: DataFrame, k: int) -> DataFrame:
    every = F.sort_array(F.flatten(F.collect_list("distances")))
    return lists.groupBy("id", "grp").agg(F.slice(every, 1, k).alias("distances"))


def nearest_inside(x: np.ndarray, k: int, p: float) -> np.ndarray:
    """``nearest`` of a block's rows among themselves; without a matrix product, by halves.

    Each half is searched by itself first, then both are compared once, with the reach found so far:
    most pairs need no exact distance, and none is sorted that is out of reach.
    """
    half = len(x) // 2
    if p == 2 or half < HALF_ROWS or half <= k or k <= 0:
        return nearest(x, x, k, p, same=True)
    parts = [x[:half], x[half:]]
    best = [nearest_inside(part, k, p) for part in parts]
    reach = [np.nan_to_num(found[:, -1], nan=np.inf, posinf=np.inf) for found in best]
    for found, (who, distance) in zip(best, nearer_pairs(*parts, *reach, k, p)):
        some, lengths = np.unique(who, return_counts=True)
        rank = np.arange(len(who)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        more = np.full((len(some), k), np.inf)
        more[np.repeat(np.arange(len(some)), lengths), rank] = distance
        found[some] = np.sort(np.hstack([found[some], more]), axis=1)[:, :k]
    return np.concatenate(best)


def _self_search(keys: list[str], carry: list[str], k: int, p: float):
    """Neighbours among the rows of one chunk."""

    def run(chunk: pa.Table) -> pa.Table:
        x = to_matrix(chunk.column("x"))
        found = to_lists(nearest_inside(x, k, p))
        columns = [chunk.column(c) for c in keys + carry]
        return pa.Table.from_arrays(columns + [found], names=keys + carry + ["distances"])

    return run


def _chunk_of(chunks: Column) -> Column:
    return F.pmod(F.xxhash64("id"), chunks).cast("int")


def _lists_of(who: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Rows that found something, and their distances as lists."""
    some, lengths = np.unique(who, return_counts=True)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return some, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(distance, pa.float64()))


def _reached(distances: pa.Array, wanted: np.ndarray) -> np.ndarray:
    """The last of each row's distances, infinite where there are less than wanted."""
    if isinstance(distances, pa.ChunkedArray):
        distances = distances.combine_chunks()
    offsets = distances.offsets.to_numpy()
    values = distances.values.to_numpy(zero_copy_only=False)
    reach = np.full(len(distances), np.inf)
    full = (np.diff(offsets) >= wanted) & (np.diff(offsets) > 0)
    reach[full] = values[offsets[1:][full] - 1]
    return reach


def _block_counts(counts: dict[int, int], width: int) -> dict[int, int]:
    """Into how many blocks each group is cut, if its rows are compared by blocks."""
    shared = math.isqrt(2 * BLOCK_PAIRS // max(1, len(counts)))
    return {
        g: max(1, min(-(-n // CHUNK_ROWS), shared), -(-n * width * 8 // SIDE_BYTES))
        for g, n in counts.items()
    }


def _by_blocks_is_cheaper(
    counts: dict[int, int], width: int, p: float, asked: int, answers: int, chunk: float
) -> bool:
    """Rough core seconds of both ways; the choice affects speed and disk, never results."""
    line = 2.5e-6 + 1e-8 * width
    pair = 1e-10 * width if p == 2 else 1e-9 * width
    cells = (asked + answers) * line + asked * chunk * (1e-8 + pair)
    if p == 1:
        pair = 4e-10 * width  # blocks are compared by 16-bit numbers
    blocks = sum(
        counts[g] * (m + 1) * line + counts[g] ** 2 * (1e-8 / m + (1.5e-9 + pair) / 2)
        for g, m in _block_counts(counts, width).items()
    )
    return blocks < cells


def _in_blocks(
    rows: DataFrame, counts: dict[int, int], width: int, k: int, p: float, id_type: str,
    spent: Sequence[DataFrame] = (),
) -> DataFrame:
    """``(id, grp, distances)`` lists with every row's k nearest: all pairs of blocks, each once.

    Tables of ``spent`` are deleted once the rows are written by blocks.  Many blocks are compared
    in several passes, so that never more than four copies of the rows are on their way.
    """
    blocks = _block_counts(counts, width)
    sizes = rows.sparkSession.createDataFrame(list(blocks.items()), "grp int, blocks int")
    parted = (
        rows.join(F.broadcast(sizes), "grp")
        .withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
        .select("id", "grp", "blocks", "block", "x")
    )
    schema = f"id {id_type}, grp int, blocks int, block int, x array<double>, distances array<double>"
    with no_shuffles_left(rows.sparkSession):
        own = materialize(
            parted.groupBy("grp", "block").applyInArrow(
                _self_search(["id", "grp"], ["blocks", "block", "x"], k, p), schema
            ),
            "knn-blocks",
        )
    discard(*spent)
    most = max(blocks.values(), default=1)
    if most == 1:
        return own.select("id", "grp", "distances")

    def compare(both: pa.Table) -> pa.Table:
        sides = [both.filter(pc.equal(both.column("block"), both.column(c)[0])) for c in ("low", "high")]
        names = ["id", "grp", "distances"]
        if not all(side.num_rows for side in sides):
            empty = pa.ListArray.from_arrays(pa.array([0], pa.int32()), pa.array([], pa.float64()))
            none = both.slice(0, 0)
            return pa.Table.from_arrays([none.column("id"), none.column("grp"), empty], names=names)
        found = nearer_pairs(
            *[to_matrix(side.column("x")) for side in sides],
            *[_reached(side.column("kth"), np.ones(side.num_rows)) for side in sides], k, p,
        )
        out = []
        for side, (who, distance) in zip(sides, found):
            some, lists = _lists_of(who, distance)
            picked = side.select(["id", "grp"]).take(pa.array(some, pa.int64()))
            out.append(pa.Table.from_arrays([*picked.columns, lists], names=names))
        return pa.concat_tables(out)

    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    meeting = (
        own.withColumn("kth", F.slice("distances", k, 1))  # says how far to look; empty: anywhere
        .select("*", others.alias("other"))
        .where(F.col("other") != F.col("block"))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    )

    def met(pairs: DataFrame) -> DataFrame:
        sides = pairs.select("id", "grp", "block", "x", "kth", "low", "high")
        return sides.groupBy("grp", "low", "high").applyInArrow(
            compare, f"id {id_type}, grp int, distances array<double>"
        )

    lists = own.select("id", "grp", "distances")
    if most <= AT_ONCE:
        return lists.unionByName(met(meeting))
    # A block has two others at each distance round the ring of blocks; a pass takes two distances.
    gap = F.col("high") - F.col("low")
    turn = F.floor((F.least(gap, F.col("blocks") - gap) - 1) / 2)
    for number in range(-(-(most // 2) // 2)):
        with no_shuffles_left(rows.sparkSession):
            best = materialize(_best_of(lists.unionByName(met(meeting.where(turn == number))), k), "knn-best")
        if number:
            discard(lists)
        lists = best
    discard(own)
    return lists


def _in_cells(
    rows: DataFrame, counts: dict[int, int], k: int, p: float, chunk_rows: int, id_type: str
) -> DataFrame:
    """``(id, grp, distances)`` lists with every row's k nearest among them."""
    spark = rows.sparkSession
    pivots = _pick_pivots(rows, counts, chunk_rows)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = to_matrix(batch.column(2))
            grp = batch.column(1).to_numpy()
            cell = np.zeros(len(x), dtype=np.int32)
            away = np.zeros(len(x))
            for g in np.unique(grp):
                at = np.nonzero(grp == g)[0]
                cell[at], away[at] = nearest_pivot(x[at], pivots[g], p)
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [pa.array(cell), pa.array(away)],
                names=["id", "grp", "x", "cell", "away"],
            )

    schema = f"id {id_type}, grp int, x array<double>, cell int, away double"
    assigned = materialize(rows.mapInArrow(assign, schema), "knn-cells")

    # One line per cell: bounded by the number of pivots, so it may be collected and broadcast.
    cell_stats = assigned.groupBy("grp", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("away").alias("inner"), F.max("away").alias("outer")
    )
    cells: dict[int, _Cells] = {
        g: _Cells(pv, counts[g], *[np.zeros(len(pv)) for _ in range(2)], *[np.zeros(len(pv), int) for _ in range(2)])
        for g, pv in pivots.items()
    }
    chunk_table = []
    for r in cell_stats.collect():
        c = cells[r.grp]
        c.inner[r.cell], c.outer[r.cell], c.members[r.cell] = r.inner, r.outer, r.n
        # Where the pivots are at their limit, cells grow before they are split.
        c.chunks[r.cell] = max(1, -(-r.n // max(chunk_rows, min(CHUNK_ROWS, c.n // 64))))
        chunk_table.append((r.grp, r.cell, int(c.chunks[r.cell])))
    chunks = spark.createDataFrame(chunk_table, "grp int, cell int, chunks int")
    placed = assigned.join(F.broadcast(chunks), ["grp", "cell"]).withColumn(
        "chunk", _chunk_of(F.col("chunks"))
    )

    carried = ["cell", "chunk", "x"]
    with no_shuffles_left(spark):
        first = materialize(
            placed.groupBy("grp", "cell", "chunk").applyInArrow(
                _self_search(["id", "grp"], carried, k, p),
                f"id {id_type}, grp int, cell int, chunk int, x array<double>, "
                "distances array<double>",
            ),
            "knn-first",
        )

    def open_targets(batch: pa.RecordBatch) -> Iterator[tuple]:
        """Where rows still have to look: ``(group, rows, cells, chunks, reach, matrix)`` per block."""
        grp = batch.column("grp").to_numpy()
        own, own_chunk = batch.column("cell").to_numpy(), batch.column("chunk").to_numpy()
        x = to_matrix(batch.column("x"))
        wanted = np.array([min(k, cells[g].n - 1) for g in grp.tolist()])
        reached = _reached(batch.column("distances"), wanted)
        for g in np.unique(grp):
            c = cells[g]
            full = min(k, c.n - 1)
            if full <= 0:
                continue  # a group of one row has no neighbours
            at = np.nonzero(grp == g)[0]
            for lo in range(0, len(at), BLOCK_ROWS):
                part = at[lo : lo + BLOCK_ROWS]
                reach = reached[part]
                short = np.isinf(reach)
                if short.any():
                    reach[short] = c.reach(x[part[short]], full, p)
                who, cell = np.nonzero(c.lower_bounds(x[part], own[part], p) < reach[:, None])
                times = c.chunks[cell]
                ends = np.cumsum(times)
                chunk = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - times, times)
                who, cell = np.repeat(who, times), np.repeat(cell, times)
                keep = ~((cell == own[part[who]]) & (chunk == own_chunk[part[who]]))
                who, cell, chunk = who[keep], cell[keep], chunk[keep]
                if len(who):
                    yield g, part[who], cell, chunk, reach[who], x

    target = ["grp", "cell", "chunk"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            asked: dict[int, np.ndarray] = {}
            # Targets are numbered: a cell's chunks follow each other.
            for g, _, cell, chunk, _, _ in open_targets(batch):
                before = np.cumsum(cells[g].chunks) - cells[g].chunks
                hits = np.bincount(before[cell] + chunk, minlength=cells[g].chunks.sum())
                asked[g] = asked[g] + hits if g in asked else hits
            for g, hits in asked.items():
                c = cells[g]
                cell = np.repeat(np.arange(len(c.chunks)), c.chunks)
                chunk = np.arange(len(cell)) - (np.cumsum(c.chunks) - c.chunks)[cell]
                some = np.nonzero(hits)[0]
                values = [np.full(len(some), g), cell[some], chunk[some]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.int32()) for v in values] + [pa.array(hits[some], pa.int64())],
                    names=[*target, "asked"],
                )

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One line per (row, cell chunk) not ruled out, in bounded portions."""
        for batch in batches:
            if not batch.num_rows:
                continue
            for g, src, cell, chunk, reach, x in open_targets(batch):
                step = max(1, SHIP_BYTES // (8 * max(1, x.shape[1])))
                for lo in range(0, len(src), step):
                    at = slice(lo, lo + step)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").take(pa.array(src[at])),
                            *[
                                pa.array(v, pa.int32())
                                for v in (np.full(len(src[at]), g), cell[at], chunk[at])
                            ],
                            to_lists(x[src[at]]),
                            pa.array(reach[at]),
                        ],
                        names=["id", *target, "x", "reach"],
                    )

    load = (
        first.mapInArrow(count, "grp int, cell int, chunk int, asked bigint")
        .groupBy(*target)
        .agg(F.sum("asked").alias("asked"))
    )
    piece_rows = max(chunk_rows, CHUNK_ROWS)
    pieces = materialize(
        load.select(*target, "asked", F.ceil(F.col("asked") / piece_rows).cast("int").alias("pieces")),
        "knn-load",
    )
    total = pieces.agg(F.sum("asked").alias("asked"), F.sum("pieces").alias("pieces")).first()
    if total.asked:
        chunk = sum(counts.values()) / max(1, sum(int(c.chunks.sum()) for c in cells.values()))
        width = next(iter(pivots.values())).shape[1]
        if _by_blocks_is_cheaper(counts, width, p, total.asked, int(total.pieces * chunk), chunk):
            source = assigned.select("id", "grp", "x")
            return _in_blocks(source, counts, width, k, p, id_type, [assigned, first, pieces])
    # Bounded by the number of cell chunks; Spark decides from the written size how to join it.
    pieces = pieces.drop("asked")
    asking = (
        first.mapInArrow(ship, f"id {id_type}, grp int, cell int, chunk int, x array<double>, reach double")
        .join(pieces, target)
        .withColumn("piece", F.pmod(F.xxhash64("id", F.lit(1)), "pieces").cast("int"))
        .drop("pieces")
    )
    answering = (
        placed.select("id", "x", *target)
        .join(pieces, target)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .drop("pieces")
    )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        empty = not n or not right.num_rows
        found = (
            np.zeros((n, 0))
            if empty
            else nearest(to_matrix(left.column("x")), to_matrix(right.column("x")), k, p, False)
        )
        reach = left.column("reach").to_numpy() if n else np.zeros(0)
        at, rank = np.nonzero(found < reach[:, None])
        some, lists = _lists_of(at, found[at, rank])
        picked = left.take(pa.array(some, pa.int64())) if n else left
        return pa.Table.from_arrays(
            [picked.column("id"), picked.column("grp"), lists], names=["id", "grp", "distances"]
        )

    keys = target + ["piece"]
    second = (
        asking.groupBy(*keys)
        .cogroup(answering.groupBy(*keys))
        .applyInArrow(compare, f"id {id_type}, grp int, distances array<double>")
    )
    return first.select("id", "grp", "distances").unionByName(second)


def knn_score(distances: Column, k: int, mode: str = "avg_k_distance") -> Column:
    """Score from the sorted distances: their mean over the first k, or the k-th one."""
    near = F.slice(distances, 1, k)
    count = F.size(near)
    if mode == "kth_distance":
        score = F.try_element_at(near, count)
    else:
        score = F.aggregate(near, F.lit(0.0), lambda acc, d: acc + d) / count
    return F.when(count > 0, score).otherwise(F.lit(0.0))
