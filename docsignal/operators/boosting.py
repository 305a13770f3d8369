"""Boosted trees of second order for a label of 0 and 1, grown on executors.

*Bins.*  Cut points of every column come from quantile summaries: a task keeps at most
``SUMMARY`` weighted values a column, summaries are merged on the executors, and a column with no more
than ``max_bins`` different values is cut between all of them.  Rows are then held as one byte a
column.

*Trees.*  A tree grows level by level.  One pass sums gradients and hessians of the logistic loss into
histograms of (node, column, bin); they are added where (node, column) is hashed to, and the best
split is sought there, so the driver receives one line a node and column, not the histograms.
Nodes beyond ``HISTOGRAM_BYTES`` are worked on in further passes.  With G, H the sums of a node:

    gain = GL^2 / (HL + l) + GR^2 / (HR + l) - G^2 / (H + l),   leaf = -rate * G / (H + l)

A split needs a gain above ``min_gain`` and ``min_child_weight`` of hessian on both sides; of equal
ones the first column and the smallest threshold win.  Rows with x <= threshold go left.

*State.*  A row's margin stands in the table; after ``REWRITE`` trees it is written anew, so a pass
walks through a few trees only and a lost executor costs a re-read.  Rows of a tree are sampled by a
hash of their key and the tree's number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as S

from docsignal.operators.matrix import SUM_SCHEMA, as_double_array, few_tasks, sums_batch, to_matrix
from docsignal.session import materialize

SUMMARY = 4096
HISTOGRAM_BYTES = 64 << 20
REWRITE = 8
ROWS = 4096
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Boosting:
    """Settings of a fit; ``max_depth`` None stands for 6."""

    rounds: int = 100
    max_depth: int | None = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    min_gain: float = 0.0
    max_bins: int = 256
    seed: int = 0

    @property
    def depth(self) -> int:
        return 6 if self.max_depth is None else int(self.max_depth)


@dataclass
class Tree:
    """Nodes by number; ``feature`` -1 marks a leaf.  ``bin`` is the threshold's place among the cuts."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, threshold: float, gain: float) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.bin[node], self.threshold[node] = feature, at, threshold
        self.left[node], self.gain[node] = left, gain
        for name, empty in (("feature", -1), ("bin", 0), ("threshold", 0.0), ("left", 0), ("value", 0.0), ("gain", 0.0)):
            getattr(self, name).extend([empty, empty])
        return left, left + 1

    def nodes(self, x: np.ndarray, cuts: Sequence) -> np.ndarray:
        """The node each row ends in; ``x <= cuts[node]`` goes left."""
        feature, left, cut = np.array(self.feature), np.array(self.left), np.array(cuts)
        node = np.zeros(len(x), np.int64)
        going = np.flatnonzero(feature[node] >= 0)
        while len(going):
            at = node[going]
            node[going] = left[at] + (x[going, feature[at]] > cut[at])
            going = going[feature[node[going]] >= 0]
        return node

    def margins(self, x: np.ndarray, binned: bool) -> np.ndarray:
        return np.array(self.value)[self.nodes(x, self.bin if binned else self.threshold)]


@dataclass
class BoostedModel:
    trees: list[Tree]
    width: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        return sum((t.margins(x, False) for t in self.trees), np.zeros(len(x)))

    def predict(self, df: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
        """``(keys..., y_true, y_pred)``."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = to_matrix(batch.column(batch.num_columns - 1))
                    said = pa.array((model.margins(x) > 0).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        list(batch.columns[:-1]) + [said], names=[*keys, "y_true", "y_pred"]
                    )

        source = as_double_array(df).select(*keys, F.col("label").cast("int").alias("y_true"), "features")
        schema = source.drop("features").schema.add(S.StructField("y_pred", S.IntegerType()))
        return source.mapInArrow(run, schema)

    def importances(self) -> np.ndarray:
        """Mean gain of a column's splits, as shares of 1 (all 0 without a split)."""
        total, count = np.zeros(self.width), np.zeros(self.width)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += g
                    count[f] += 1
        mean = total / np.maximum(count, 1)
        return mean / mean.sum() if mean.sum() else mean

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (n, i, t.feature[i], t.bin[i], t.threshold[i], t.left[i], t.value[i], t.gain[i], self.width)
            for n, t in enumerate(self.trees)
            for i in range(len(t.feature))
        ]
        schema = (
            "tree int, node int, feature int, bin int, threshold double, left int, value double, "
            "gain double, width int"
        )
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        trees: dict[int, Tree] = {}
        width = 0
        for r in spark.read.parquet(path).orderBy("tree", "node").collect():
            t = trees.setdefault(r.tree, Tree([], [], [], [], [], []))
            for name in ("feature", "bin", "threshold", "left", "value", "gain"):
                getattr(t, name).append(r[name])
            width = r.width
        return cls([trees[n] for n in sorted(trees)], width)


# --- bins -----------------------------------------------------------------------------------------


def merged(values: np.ndarray, weights: np.ndarray, size: int = SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """A summary of at most ``size`` weighted values: all if they fit, else at equal steps of rank.

    Each step of merging moves a rank by at most 1 / size of all rows; the least and greatest stay.
    """
    values, place = np.unique(values, return_inverse=True)
    weights = np.bincount(place, weights, minlength=len(values))
    if len(values) <= size:
        return values, weights
    sums = np.cumsum(weights)
    picks = np.searchsorted(sums, np.linspace(sums[0], sums[-1], size))
    picks = np.unique(np.append(0, np.minimum(picks, len(values) - 1)))
    return values[picks], np.diff(sums[picks], prepend=0.0)


def cut_points(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Values between which a column is cut: all but the greatest, or those at equal steps of rank."""
    if len(values) > bins:
        sums = np.cumsum(weights)
        at = np.searchsorted(sums, sums[-1] * np.arange(1, bins) / bins)
        return np.unique(values[at[at < len(values) - 1]])
    return values[:-1]


def column_cuts(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """The cut points of every column, from merged summaries; one short line a column comes back."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            x = to_matrix(batch.column(0)) if batch.num_rows else np.zeros((0, 0))
            for c in range(x.shape[1]):
                old = found.get(c, (np.zeros(0), np.zeros(0)))
                found[c] = merged(np.append(old[0], x[:, c]), np.append(old[1], np.ones(len(x))))
        if found:
            yield sums_batch({(c, 0): np.concatenate(s) for c, s in found.items()})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            for c, both in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                values, weights = np.array(both).reshape(2, -1)
                old = found.get(c, (np.zeros(0), np.zeros(0)))
                found[c] = merged(np.append(old[0], values), np.append(old[1], weights))
        if found:
            yield sums_batch({(c, 0): cut_points(*s, bins) for c, s in found.items()})

    parts = few_tasks(rows.select("features")).mapInArrow(summarise, SUM_SCHEMA)
    lines = parts.repartition("key").mapInArrow(cut, SUM_SCHEMA).toArrow()
    cuts = dict(zip(lines["key"].to_pylist(), lines["total"].to_pylist()))
    return [np.array(cuts[c], dtype=np.float64) for c in sorted(cuts)]


def _binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = to_matrix(batch.column(2))
            places = [np.searchsorted(c, x[:, i]).astype(np.uint8) for i, c in enumerate(cuts)]
            flat = pa.py_buffer(np.stack(places, axis=1).tobytes())
            ends = pa.py_buffer(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.Array.from_buffers(pa.binary(), len(x), [None, ends, flat]),
                 pa.array(np.zeros(len(x)))],
                names=["h", "label", "bins", "margin"],
            )

    return rows.mapInArrow(run, "h long, label int, bins binary, margin double")


def bytes_of(column: pa.Array, width: int) -> np.ndarray:
    _, offsets, data = column.buffers()
    start = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, np.uint8)[start : start + len(column) * width].reshape(-1, width)


# --- growing --------------------------------------------------------------------------------------


def uniform(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number from 0 to 1 for every row and tree: a hash of the key's hash, the seed and the tree's number."""
    v = h.astype(np.uint64) ^ np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        v = (v ^ (v >> np.uint64(shift))) * np.uint64(factor)
    return (v ^ (v >> np.uint64(31))) / float(1 << 64)


def in_sample(h: np.ndarray, tree: int, config: Boosting) -> np.ndarray:
    """Which rows a tree sees."""
    if config.subsample >= 1:
        return np.ones(len(h), bool)
    return uniform(h, tree, config.seed) < config.subsample


def best_split(histogram: np.ndarray, config: Boosting) -> tuple[float, int, float, float, float, float]:
    """``(gain, bin, GL, HL, G, H)`` of a column's histogram of gradients and hessians; gain -1: none."""
    g, h = np.cumsum(histogram, axis=1)
    whole_g, whole_h, l2 = g[-1], h[-1], config.reg_lambda
    left, right = h >= config.min_child_weight, whole_h - h >= config.min_child_weight
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g * g / (h + l2) + (whole_g - g) ** 2 / (whole_h - h + l2) - whole_g**2 / (whole_h + l2)
    gain = np.where(left & right, gain, -1.0)
    at = int(np.argmax(gain))
    return float(gain[at]), at, float(g[at]), float(h[at]), float(whole_g), float(whole_h)


def _level(
    state: DataFrame, done: list[Tree], tree: Tree, number: int, nodes: list[int], width: int, config: Boosting
) -> dict[int, dict[int, np.ndarray]]:
    """The best split of every open node and column: ``{node: {column: (gain, bin, GL, HL, G, H)}}``."""
    bins = config.max_bins
    slot = np.full(len(tree.feature), -1)
    slot[nodes] = np.arange(len(nodes))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(nodes) * width * bins
        total = np.zeros((2, size))
        seen = np.zeros(len(nodes), bool)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                x = bytes_of(part.column(2), width)
                at = slot[tree.nodes(x, tree.bin)]
                used = (at >= 0) & in_sample(part.column(0).to_numpy(), number, config)
                if not used.any():
                    continue
                x, at, label = x[used], at[used], part.column(1).to_numpy()[used]
                margin = part.column(3).to_numpy()[used] + sum(
                    (t.margins(x, True) for t in done), np.zeros(len(x))
                )
                p = 1.0 / (1.0 + np.exp(-margin))
                place = ((at[:, None] * width + np.arange(width)) * bins + x).ravel()
                total[0] += np.bincount(place, np.repeat(p - label, width), minlength=size)
                total[1] += np.bincount(place, np.repeat(p * (1.0 - p), width), minlength=size)
                seen[at] = True
        lines = total.reshape(2, len(nodes), width, bins)
        found = {
            (nodes[n], c): lines[:, n, c].ravel() for n in np.flatnonzero(seen) for c in range(width)
        }
        if found:
            yield sums_batch(found)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            values = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            for n, c, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), values):
                totals[n, c] = totals[n, c] + line if (n, c) in totals else line.copy()
        if totals:
            yield sums_batch({k: np.array(best_split(v.reshape(2, -1), config)) for k, v in totals.items()})

    parts = few_tasks(state).mapInArrow(sums, SUM_SCHEMA)
    lines = parts.repartition("key", "row").mapInArrow(choose, SUM_SCHEMA).toArrow()
    out: dict[int, dict[int, np.ndarray]] = {}
    for n, c, line in zip(*(lines[name].to_pylist() for name in ("key", "row", "total"))):
        out.setdefault(n, {})[c] = np.array(line)
    return out


def _grow(
    state: DataFrame, done: list[Tree], number: int, cuts: list[np.ndarray], config: Boosting
) -> Tree:
    tree, width = Tree(), len(cuts)
    most = max(1, HISTOGRAM_BYTES // (16 * width * config.max_bins))
    leaf = lambda g, h: float(-config.learning_rate * g / (h + config.reg_lambda))
    open_nodes = [0]
    for _ in range(config.depth):
        found: dict[int, dict[int, np.ndarray]] = {}
        for i in range(0, len(open_nodes), most):
            part = open_nodes[i : i + most]
            found.update(_level(state, done, tree, number, part, width, config))
        following = []
        for node in open_nodes:
            lines = found.get(node)
            if not lines:
                continue
            column = min(lines, key=lambda c: (-lines[c][0], c))
            gain, at, gl, hl, g, h = lines[column]
            if node == 0:
                tree.value[0] = leaf(g, h)
            if gain <= max(config.min_gain, LEAST_GAIN):
                continue
            threshold = float(cuts[column][int(at)])
            left, right = tree.split(node, column, int(at), threshold, float(gain))
            tree.value[left], tree.value[right] = leaf(gl, hl), leaf(g - gl, h - hl)
            following += [left, right]
        open_nodes = following
        if not open_nodes:
            break
    return tree


def binned_rows(df: DataFrame, config: Boosting, key: str) -> tuple[DataFrame, list[np.ndarray]]:
    """``(h, label, bins, margin)`` as a written table, and the cut points of every column."""
    if not 2 <= config.max_bins <= 256:
        raise ValueError("max_bins must be between 2 and 256")
    h = F.xxhash64(key) if key in df.columns else F.xxhash64("features")
    rows = as_double_array(df).select(h.alias("h"), F.col("label").cast("int").alias("label"), "features")
    cuts = column_cuts(rows, config.max_bins)
    if not cuts:
        raise ValueError("no rows to fit on")
    return materialize(_binned(rows, cuts), "boosting-bins"), cuts


def fit_boosted(df: DataFrame, config: Boosting, key: str = "doc_id") -> BoostedModel:
    """Fit on ``label`` (0, 1) and ``features``; rows are sampled by ``key`` if the frame has it."""
    state, cuts = binned_rows(df, config, key)
    trees: list[Tree] = []
    fresh: list[Tree] = []
    for number in range(config.rounds):
        fresh.append(_grow(state, fresh, number, cuts, config))
        trees.append(fresh[-1])
        if len(fresh) == REWRITE and number + 1 < config.rounds:
            state, fresh = materialize(_moved(state, fresh, len(cuts)), "boosting-margins"), []
    return BoostedModel(trees, len(cuts))


def _moved(state: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """The rows with their margins after ``trees``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = bytes_of(batch.column(2), width)
                margin = batch.column(3).to_numpy() + sum((t.margins(x, True) for t in trees), np.zeros(len(x)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margin)], names=batch.schema.names)

    return state.mapInArrow(run, state.schema)


def first_splits(df: DataFrame, config: Boosting, key: str = "doc_id") -> DataFrame:
    """The best first split of every column: ``feature, threshold, gain, left_value, right_value``."""
    state, cuts = binned_rows(df, config, key)
    lines = _level(state, [], Tree(), 0, [0], len(cuts), config)[0]
    leaf = lambda g, h: float(-config.learning_rate * g / (h + config.reg_lambda))
    rows = [
        (c, float(cuts[c][int(at)]), float(gain), leaf(gl, hl), leaf(g - gl, h - hl))
        for c, (gain, at, gl, hl, g, h) in sorted(lines.items())
        if gain > max(config.min_gain, LEAST_GAIN)
    ]
    schema = "feature int, threshold double, gain double, left_value double, right_value double"
    return df.sparkSession.createDataFrame(rows, schema)
