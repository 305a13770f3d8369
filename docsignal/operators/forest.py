"""Random forests without a depth limit, for a label of 0 and 1.

*Large nodes* are split level by level for all trees at once: one pass counts (node, column, bin, label)
on the executors, counts are added where (node, column) is hashed to, and the driver receives one line
a node and column.  *Small nodes*, of no more in-bag rows than fit in ``SMALL_BYTES``, leave the levels:
their rows are shuffled together once and each is grown to its end in one task, however deep.

A tree draws rows with replacement: a row's copies are a Poisson number from a hash of its key and the
tree's number.  Every node looks at its own ``columns`` columns, drawn from a hash of its path from the
root, and at all columns if none of these can be split.  Splits maximise the decrease of the Gini
impurity, also where that is 0; of equal ones the first column and the smallest threshold win.  Counts
are whole numbers, so a forest does not depend on how rows are partitioned.

*The model.*  An unlimited forest grows with its rows, so only the large nodes are kept on the driver.
Grown small nodes stay in a table.  Predicting walks through them in shards of ``SHARD_BYTES``, which are
broadcast one after the other while each row carries the sum of its trees' answers: no shuffle, and no
row waits for another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from docsignal.operators.boosting import Boosting, Tree, binned_rows, bytes_of, uniform
from docsignal.operators.matrix import SUM_SCHEMA, as_double_array, few_tasks, sums_batch, to_matrix
from docsignal.session import materialize

SMALL_BYTES = 32 << 20
HISTOGRAM_BYTES = 64 << 20
SHARD_BYTES = 64 << 20
NODE_BYTES = 40
REWRITE = 8
ROWS = 4096
DIGITS = 10  # scores that agree so far are equal
#: Shares of rows that a tree draws at most 0, 1, 2, ... times.
DRAWN = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


@dataclass(frozen=True)
class Forest:
    """Settings of a fit; ``columns`` a node looks at: None stands for the root of their number."""

    trees: int = 100
    max_depth: int | None = None
    min_leaf: int = 1
    columns: int | None = None
    max_bins: int = 256
    seed: int = 0


@dataclass(frozen=True)
class Rules:
    """What every node needs to know, on the driver as in a task."""

    config: Forest
    width: int
    weights: tuple[float, float]

    @property
    def least(self) -> int:
        return max(1, self.config.min_leaf)

    def columns(self, path: int) -> np.ndarray:
        n = self.config.columns or max(1, math.isqrt(self.width))
        return np.sort(np.random.default_rng(path).permutation(self.width)[:n])

    def ends(self, n: np.ndarray, depth: int) -> bool:
        """Whether a node of ``n`` = (zeros, ones) rows at ``depth`` is a leaf."""
        limit = self.config.max_depth
        return not n.all() or n.sum() < 2 * self.least or (limit is not None and depth >= limit)

    def share(self, n: np.ndarray) -> float:
        zeros, ones = n * self.weights
        return float(ones / (zeros + ones)) if zeros + ones else 0.0

    def decrease(self, n: np.ndarray, left: np.ndarray) -> float:
        """How much a split lowers the weighted impurity."""
        return max(0.0, float(self._purity(left) + self._purity(n - left) - self._purity(n)))

    def _purity(self, n: np.ndarray) -> np.ndarray:
        """Weighted rows less their Gini impurity, of counts along the last axis."""
        n = n * np.array(self.weights)
        return (n * n).sum(-1) / np.maximum(n.sum(-1), 1e-300)

    def splits(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, bin and left counts of the best cut of every column of ``(columns, bins, 2)``; score -1: none."""
        left = counts.cumsum(1)
        whole = left[:, -1:]
        right = whole - left
        fit = (left.sum(2) >= self.least) & (right.sum(2) >= self.least)
        total = np.maximum((whole * np.array(self.weights)).sum(2), 1e-300)
        score = np.where(fit, np.round((self._purity(left) + self._purity(right)) / total, DIGITS), -1.0)
        at = score.argmax(1)
        row = np.arange(len(counts))
        return score[row, at], at, left[row, at]


def root_path(seed: int, tree: int) -> int:
    return _mix(seed * 1_000_003 + tree + 1)


def child_path(path: int, side: int) -> int:
    return _mix(2 * path + side + 1)


def _mix(v: int) -> int:
    v = (v * 0x9E3779B97F4A7C15) % (1 << 64)
    v = ((v ^ (v >> 30)) * 0xBF58476D1CE4E5B9) % (1 << 64)
    return (v ^ (v >> 27)) >> 1  # fits a long


def copies(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row."""
    return np.searchsorted(DRAWN, uniform(h, tree, seed), "right")


# --- small nodes ----------------------------------------------------------------------------------


def grow_small(
    x: np.ndarray, label: np.ndarray, times: np.ndarray, path: int, depth: int, rules: Rules
) -> Tree:
    """The tree over the rows of one node, grown to its end."""
    tree, bins = Tree(), rules.config.max_bins
    waiting = [(0, np.arange(len(x)), path, depth)]
    while waiting:
        node, rows, path, depth = waiting.pop()
        n = np.bincount(label[rows], times[rows], 2)
        tree.value[node] = rules.share(n)
        if rules.ends(n, depth):
            continue
        for columns in (rules.columns(path), np.arange(rules.width)):
            place = ((np.arange(len(columns)) * bins + x[rows][:, columns]) * 2 + label[rows][:, None]).ravel()
            counts = np.bincount(place, np.repeat(times[rows], len(columns)), len(columns) * bins * 2)
            score, at, left = rules.splits(counts.reshape(-1, bins, 2))
            best = int(score.argmax())
            if score[best] >= 0:
                break
        else:
            continue
        column, cut = int(columns[best]), int(at[best])
        below = x[rows, column] <= cut
        sides = tree.split(node, column, cut, 0.0, rules.decrease(n, left[best]))
        for side, child in enumerate(sides):
            waiting.append((child, rows[below == (side == 0)], child_path(path, side), depth + 1))
    return tree


PART = (
    "place int, tree int, feature array<int>, bin array<int>, left array<int>, value array<double>,"
    " gain array<double>"
)
PART_TYPES = [pa.int32(), pa.int32(), *[pa.list_(pa.int32())] * 3, *[pa.list_(pa.float64())] * 2]
PART_NAMES = ["place", "tree", "feature", "bin", "left", "value", "gain"]


def _grow_parts(state: DataFrame, trees: list[Tree], small: list[tuple[int, int, int, int]], rules: Rules) -> DataFrame:
    """Every small node ``(tree, node, path, depth)`` grown; one row each, ``place`` is its number."""
    slots = _slots(trees, [(t, node) for t, node, *_ in small])
    paths, depths = [s[2] for s in small], [s[3] for s in small]
    width, seed = rules.width, rules.config.seed

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            h, x = batch.column(0).to_numpy(), bytes_of(batch.column(2), width)
            for t, slot in slots.items():
                place = slot[trees[t].nodes(x, trees[t].bin)]
                times = copies(h, t, seed)
                used = np.flatnonzero((place >= 0) & (times > 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[used], pa.int32()), pa.array(np.full(len(used), t), pa.int32()),
                     batch.column(1).take(pa.array(used)), pa.array(times[used], pa.int32()),
                     batch.column(2).take(pa.array(used))],
                    names=["place", "tree", "label", "times", "bins"],
                )

    def grow(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        place, t = table["place"][0].as_py(), table["tree"][0].as_py()
        x = bytes_of(table["bins"].chunk(0), width)
        label, times = table["label"].to_numpy(), table["times"].to_numpy()
        grown = grow_small(x, label, times, paths[place], depths[place], rules)
        row = [place, t, grown.feature, grown.bin, grown.left, grown.value, grown.gain]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(row, PART_TYPES)], names=PART_NAMES)

    dealt = state.mapInArrow(deal, "place int, tree int, label int, times int, bins binary")
    return dealt.groupBy("place", "tree").applyInArrow(grow, PART)


def _slots(trees: list[Tree], nodes: Sequence[tuple[int, int]]) -> dict[int, np.ndarray]:
    """For each tree with wanted nodes: which of ``nodes`` each of its nodes is, or -1."""
    slots: dict[int, np.ndarray] = {}
    for i, (t, node) in enumerate(nodes):
        if t not in slots:
            slots[t] = np.full(len(trees[t].feature), -1)
        slots[t][node] = i
    return slots


# --- large nodes ----------------------------------------------------------------------------------


def _level(
    state: DataFrame, trees: list[Tree], nodes: list[tuple[int, int]], columns: np.ndarray, rules: Rules
) -> dict[int, list[np.ndarray]]:
    """Of each node by its place in ``nodes``, a line for each of its ``columns``: score, bin, left, all counts."""
    slots = _slots(trees, nodes)
    bins, looked, width, seed = rules.config.max_bins, columns.shape[1], rules.width, rules.config.seed

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(nodes) * looked * bins * 2)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                h, rows = part.column(0).to_numpy(), bytes_of(part.column(2), width)
                labels = part.column(1).to_numpy()
                for t, slot in slots.items():
                    at = slot[trees[t].nodes(rows, trees[t].bin)]
                    times = copies(h, t, seed)
                    used = np.flatnonzero((at >= 0) & (times > 0))
                    if not len(used):
                        continue
                    at = at[used]
                    x = rows[used[:, None], columns[at]]
                    place = (at[:, None] * looked + np.arange(looked)) * bins + x
                    place = (place * 2 + labels[used][:, None]).ravel()
                    np.add.at(total, place, np.repeat(times[used], looked).astype(np.float64))
        lines = total.reshape(len(nodes), looked, bins * 2)
        found = {(int(n), c): lines[n, c] for n in np.flatnonzero(lines.any((1, 2))) for c in range(looked)}
        if found:
            yield sums_batch(found)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            values = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            for n, c, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), values):
                totals[n, c] = totals[n, c] + line if (n, c) in totals else line.copy()
        lines = {}
        for at, line in totals.items():
            counts = line.reshape(1, bins, 2)
            score, cut, left = rules.splits(counts)
            lines[at] = np.concatenate([score, cut, left[0], counts[0].sum(0)])
        if lines:
            yield sums_batch(lines)

    parts = few_tasks(state).mapInArrow(count, SUM_SCHEMA)
    lines = parts.repartition("key", "row").mapInArrow(choose, SUM_SCHEMA).toArrow()
    out: dict[int, list[np.ndarray]] = {}
    rows = sorted(zip(*(lines[name].to_pylist() for name in ("key", "row", "total"))))
    for n, _, line in rows:
        out.setdefault(n, []).append(np.array(line))
    return out


def _best(state: DataFrame, trees: list[Tree], opened: list[tuple], rules: Rules) -> dict[int, tuple[int, np.ndarray]]:
    """The column and line of the best split of every open node that has one; others lack or score -1."""
    out: dict[int, tuple[int, np.ndarray]] = {}

    def look(places: list[int], columns: np.ndarray) -> None:
        most = max(1, HISTOGRAM_BYTES // (16 * columns.shape[1] * rules.config.max_bins))
        for i in range(0, len(places), most):
            part = places[i : i + most]
            found = _level(state, trees, [opened[p][:2] for p in part], columns[i : i + most], rules)
            for n, lines in found.items():
                at = max(range(len(lines)), key=lambda c: (lines[c][0], -c))
                out[part[n]] = int(columns[i + n][at]), lines[at]

    look(list(range(len(opened))), np.array([rules.columns(o[2]) for o in opened]))
    stuck = [p for p, (_, line) in out.items() if line[0] < 0]
    if stuck:
        look(stuck, np.tile(np.arange(rules.width), (len(stuck), 1)))
    return out


def fit_forest(
    df: DataFrame,
    config: Forest = Forest(),
    weights: tuple[float, float] = (1.0, 1.0),
    key: str = "doc_id",
) -> ForestModel:
    """Fit on ``label`` (0, 1) and ``features``; ``weights`` of the classes; rows are drawn by ``key``.

    A frame without ``key`` draws rows by their features.  Rows that repeat a key are drawn together.
    Values between two cut points of a column are one (as for boosted trees); without rows it fails.
    """
    state, cuts = binned_rows(df, Boosting(max_bins=config.max_bins), key)
    rules = Rules(config, len(cuts), weights)
    fits = max(1, SMALL_BYTES // (len(cuts) + 16))
    trees = [Tree() for _ in range(config.trees)]
    roots = [(t, 0, root_path(config.seed, t), 0) for t in range(config.trees)]
    opened, small = (roots, []) if state.count() > fits else ([], roots)
    while opened:
        best, following = _best(state, trees, opened, rules), []
        for place, (t, node, path, depth) in enumerate(opened):
            if place not in best:
                continue  # a tree that drew no row
            column, line = best[place]
            left, n = line[2:4], line[4:6]
            tree = trees[t]
            tree.value[node] = rules.share(n)
            if line[0] < 0 or rules.ends(n, depth):
                continue
            sides = tree.split(node, column, int(line[1]), 0.0, rules.decrease(n, left))
            for side, (child, m) in enumerate(zip(sides, (left, n - left))):
                tree.value[child] = rules.share(m)
                if not rules.ends(m, depth + 1):
                    group = small if m.sum() <= fits else following
                    group.append((t, child, child_path(path, side), depth + 1))
        opened = following
    parts = materialize(_grow_parts(state, trees, small, rules), "forest-parts")
    return ForestModel.of(trees, [s[:2] for s in small], parts, cuts)


# --- the model ------------------------------------------------------------------------------------


@dataclass
class Shard:
    """Grown small nodes as one array of nodes: ``root`` of each place, -1 if it stands elsewhere."""

    root: np.ndarray
    feature: np.ndarray
    left: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def values(self, x: np.ndarray, place: np.ndarray) -> np.ndarray:
        """What the small node of ``place`` says of every row; 0 where there is none in this shard."""
        out = np.zeros(len(x))
        rows = np.flatnonzero(place >= 0)
        rows = rows[self.root[place[rows]] >= 0]
        node = self.root[place[rows]]
        going = np.flatnonzero(self.feature[node] >= 0)
        while len(going):
            at = node[going]
            node[going] = self.left[at] + (x[rows[going], self.feature[at]] > self.threshold[at])
            going = going[self.feature[node[going]] >= 0]
        out[rows] = self.value[node]
        return out


@dataclass
class ForestModel:
    trees: list[Tree]
    at: list[tuple[int, int]]  # (tree, node) of every small node, by place
    parts: DataFrame
    cuts: list[np.ndarray]
    ends: list[int]  # the place behind each shard
    shares: np.ndarray

    @classmethod
    def of(cls, trees, at, parts, cuts) -> ForestModel:
        sizes = np.zeros(len(at), np.int64)
        for r in parts.select("place", F.size("feature").alias("n")).collect():
            sizes[r.place] = r.n * NODE_BYTES
        ends, held = [], 0
        for place, size in enumerate(sizes.tolist()):
            if held and held + size > SHARD_BYTES:
                ends.append(place)
                held = 0
            held += size
        ends.append(len(at))
        gains = np.zeros((len(trees), len(cuts)))
        for t, tree in enumerate(trees):
            for f, g in zip(tree.feature, tree.gain):
                if f >= 0:
                    gains[t, f] += g
        pairs = parts.select("tree", F.inline(F.arrays_zip("feature", "gain"))).where("feature >= 0")
        for r in pairs.groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect():
            gains[r.tree, r.feature] += r.gain
        whole = gains.sum(1, keepdims=True)
        mean = np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).mean(0)
        return cls(trees, at, parts, cuts, ends, mean / mean.sum() if mean.sum() else mean)

    @property
    def width(self) -> int:
        return len(self.cuts)

    def importances(self) -> np.ndarray:
        """Mean decrease of impurity over the trees, as shares of 1 (all 0 without a split)."""
        return self.shares

    def _thresholds(self, feature: np.ndarray, bins: np.ndarray) -> np.ndarray:
        starts = np.cumsum([0] + [len(c) for c in self.cuts])
        flat = np.append(np.concatenate(self.cuts), 0.0)
        return flat[np.where(feature >= 0, starts[np.maximum(feature, 0)] + bins, len(flat) - 1)]

    def shard(self, number: int) -> Shard:
        low, high = ([0] + self.ends)[number], self.ends[number]
        root, found, n = np.full(len(self.at), -1), [], 0
        rows = self.parts.where(F.col("place").between(low, high - 1)).drop("gain").toArrow().to_pylist()
        for r in rows:
            feature, left = np.array(r["feature"]), np.array(r["left"])
            root[r["place"]] = n
            found.append((feature, left + n, self._thresholds(feature, np.array(r["bin"])), np.array(r["value"])))
            n += len(feature)
        empty = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))]
        return Shard(root, *(np.concatenate(c) for c in zip(*(found or empty))))

    def predict(self, df: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
        """``(keys..., y_true, y_pred)``: 1 where the mean of the trees' shares of ones is above a half."""
        rows = as_double_array(df).select(
            *keys, F.col("label").cast("int").alias("y_true"), "features", F.lit(0.0).alias("_ones")
        )
        for number in range(len(self.ends)):
            rows = self._added(rows, number)
            if number % REWRITE == REWRITE - 1 and number + 1 < len(self.ends):
                rows = materialize(rows, "forest-answers")
        said = F.round(F.col("_ones") / len(self.trees), DIGITS) > 0.5
        return rows.select(*keys, "y_true", said.cast("int").alias("y_pred"))

    def _added(self, rows: DataFrame, number: int) -> DataFrame:
        """The rows with the answers of a shard added; the first adds those of the large nodes' own leaves."""
        trees, slots = self.trees, _slots(self.trees, self.at)
        cuts = [self._thresholds(np.array(t.feature), np.array(t.bin)) for t in trees]
        shared = rows.sparkSession.sparkContext.broadcast((self.shard(number), trees, slots, cuts))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, trees, slots, cuts = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, total = to_matrix(batch.column(batch.num_columns - 2)), batch.column(batch.num_columns - 1).to_numpy()
                for t, tree in enumerate(trees):
                    node = tree.nodes(x, cuts[t])
                    place = slots[t][node] if t in slots else np.full(len(x), -1)
                    if number == 0:
                        total = total + np.where(place < 0, np.array(tree.value)[node], 0.0)
                    total = total + shard.values(x, place)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(total)], names=batch.schema.names)

        return rows.mapInArrow(run, rows.schema)

    def save(self, spark: SparkSession, path: str) -> None:
        """Tables of the large nodes, the grown small ones, where these hang, and the cut points."""
        tops = [(t, x.feature, x.bin, x.left, x.value, x.gain) for t, x in enumerate(self.trees)]
        tables = {
            "tops": (tops, PART.removeprefix("place int, ")),
            "at": ([(i, *a) for i, a in enumerate(self.at)], "place int, tree int, node int"),
            "cuts": ([(i, c.tolist()) for i, c in enumerate(self.cuts)], "feature int, cuts array<double>"),
        }
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
        self.parts.write.mode("overwrite").parquet(f"{path}/parts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        tops = spark.read.parquet(f"{path}/tops").orderBy("tree").collect()
        trees = [
            Tree(list(r.feature), list(r.bin), [0.0] * len(r.feature), list(r.left), list(r.value), list(r.gain))
            for r in tops
        ]
        at = [(r.tree, r.node) for r in spark.read.parquet(f"{path}/at").orderBy("place").collect()]
        cuts = [np.array(r.cuts, np.float64) for r in spark.read.parquet(f"{path}/cuts").orderBy("feature").collect()]
        return cls.of(trees, at, spark.read.parquet(f"{path}/parts"), cuts)
