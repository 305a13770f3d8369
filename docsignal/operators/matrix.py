"""Dense matrix work over ``array<double>`` rows: scalers, Gram sums, covariance, row maps.

Rows stay in DataFrames.  Partitions reduce their rows to sums of model size (d values or d x d),
those sums are added on the executors by (key, matrix row), and only the totals reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F, types as S

from docsignal.functions.lookup import constant
from docsignal.session import no_shuffles_left

SUM_SCHEMA = "key int, row int, total array<double>"


def to_matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column as a 2-D float64 matrix.

    A NULL row, rows of different lengths or a NULL value fail: they would shift other values.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError(f"{column.null_count} of {n} feature vectors are NULL")
    offsets = column.offsets.to_numpy()
    width = int(offsets[1] - offsets[0])
    uneven = np.flatnonzero(np.diff(offsets) != width)
    if len(uneven):
        other = int(offsets[uneven[0] + 1] - offsets[uneven[0]])
        raise ValueError(f"feature vectors of different lengths: {width} and {other}")
    values = column.flatten()
    if values.null_count:
        raise ValueError(f"{values.null_count} feature values are NULL")
    return values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, width)


def to_lists(matrix: np.ndarray) -> pa.Array:
    """A 2-D matrix as an Arrow list column."""
    n, d = matrix.shape
    offsets = pa.array(np.arange(0, (n + 1) * d, d) if d else np.zeros(n + 1), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def as_double_array(df: DataFrame, features: str = "features") -> DataFrame:
    """Feature arrays of doubles; NULL and NaN values count as 0."""
    numbers = F.transform(
        F.col(features).cast("array<double>"), lambda x: F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))
    )
    return df.withColumn(features, numbers)


def few_tasks(df: DataFrame) -> DataFrame:
    """At most a few tasks per core, without a shuffle, so that each sums many rows."""
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def sum_by_key(partials: DataFrame) -> dict[int, dict[int, np.ndarray]]:
    """Add partial sums ``(key, row, total)`` element by element: ``{key: {row: total}}``.

    A hash shuffle on (key, row) spreads the adding over the executors; the driver receives one
    line per (key, row).
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for at, part in _lines(batch):
                totals[at] = totals[at] + part if at in totals else part.copy()
        if totals:
            yield sums_batch(totals)

    with no_shuffles_left(partials.sparkSession):
        added = partials.repartition("key", "row").mapInArrow(add, SUM_SCHEMA).toArrow()
    out: dict[int, dict[int, np.ndarray]] = {}
    for batch in added.to_batches():
        for (key, row), part in _lines(batch):
            lines = out.setdefault(key, {})
            lines[row] = lines[row] + part if row in lines else part
    return out


def _lines(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
    offsets = batch.column(2).offsets.to_numpy()
    flat = batch.column(2).values.to_numpy(zero_copy_only=False)
    for i, at in enumerate(keys):
        yield at, flat[offsets[i] : offsets[i + 1]]


def sums_batch(totals: Mapping[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    keys = list(totals)
    lengths = [len(totals[k]) for k in keys]
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    flat = pa.array(np.concatenate([totals[k] for k in keys]), pa.float64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.int32()),
            pa.array([k[1] for k in keys], pa.int32()),
            pa.ListArray.from_arrays(offsets, flat),
        ],
        names=["key", "row", "total"],
    )


# --- scaling -------------------------------------------------------------------------------


@dataclass
class Scaler:
    """Column mean and population standard deviation; a constant column divides by 1."""

    mean: np.ndarray
    std: np.ndarray
    n: int

    @property
    def divisor(self) -> np.ndarray:
        return np.where(self.std > 0, self.std, 1.0)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.divisor

    @classmethod
    def identity(cls, d: int, n: int = 0) -> Scaler:
        return cls(np.zeros(d), np.ones(d), n)


def _merge(parts: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> Scaler:
    """Combine (count, mean, squared deviations) of disjoint groups."""
    n, mean, dev = parts[0]
    for n2, mean2, dev2 in parts[1:]:
        total = n + n2
        shift = mean2 - mean
        dev = dev + dev2 + shift * shift * (n * n2 / total)
        mean = mean + shift * (n2 / total)
        n = total
    # A column that never varies must have exactly zero spread, whatever the rounding.
    dev = np.where(dev <= 1e-24 * n * np.maximum(mean * mean, 1e-300), 0.0, dev)
    return Scaler(mean, np.sqrt(dev / n), n)


def _group_moments(
    df: DataFrame, features: str, group: str
) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    summary = Summarizer.metrics("count", "mean", "variance").summary(array_to_vector(features))
    rows = df.groupBy(group).agg(summary.alias("s")).collect()
    return {
        r[group]: (
            r.s["count"],
            r.s.mean.toArray(),
            r.s.variance.toArray() * max(r.s["count"] - 1, 0),
        )
        for r in rows
    }


def fit_scaler(df: DataFrame, features: str = "features") -> Scaler:
    """One pass, partial sums on the executors (sample variance turned into population)."""
    parts = _group_moments(df.withColumn("_g", F.lit(0)), features, "_g")
    return _merge(list(parts.values()))


def fit_fold_scalers(
    df: DataFrame, features: str = "features", fold: str = "fold"
) -> dict[int | None, Scaler]:
    """Scalers of every training fold (all rows but that fold) and of all rows (key None).

    One pass over the data: the moments of a training fold are merged from the other folds'.
    """
    parts = _group_moments(df, features, fold)
    out: dict[int | None, Scaler] = {None: _merge([parts[f] for f in sorted(parts)])}
    for left_out in sorted(parts):
        rest = [parts[f] for f in sorted(parts) if f != left_out]
        out[left_out] = _merge(rest) if rest else out[None]
    return out


def append_columns(
    df: DataFrame,
    compute: Callable[[np.ndarray], Mapping[str, pa.Array]],
    fields: Sequence[S.StructField],
    features: str = "features",
) -> DataFrame:
    """Append columns computed from the feature matrix, one Arrow batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = to_matrix(batch.column(batch.schema.get_field_index(features)))
            extra = compute(x)
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [extra[f.name] for f in fields],
                names=batch.schema.names + [f.name for f in fields],
            )

    return df.mapInArrow(run, S.StructType(list(df.schema.fields) + list(fields)))


def scale(df: DataFrame, scaler: Scaler, features: str = "features") -> DataFrame:
    """Standardise the feature array as a row expression."""
    centred = F.zip_with(F.col(features), constant(scaler.mean), lambda x, m: x - m)
    scaled = F.zip_with(centred, constant(scaler.divisor), lambda x, s: x / s)
    return df.withColumn(features, scaled)


# --- covariance ----------------------------------------------------------------------------


@dataclass
class GramSums:
    n: int
    gram: np.ndarray  # sum of z z'
    quartic: float  # sum of |z|^4


def gram_sums(
    df: DataFrame,
    scalers: Mapping[int | None, Scaler],
    features: str = "features",
    fold: str | None = None,
) -> dict[int | None, GramSums]:
    """Gram sums of scaled rows for every scaler; scaler ``f`` skips the rows of fold ``f``."""
    groups = list(scalers)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = to_matrix(batch.column(0))
            folds = batch.column(1).to_numpy(zero_copy_only=False)
            for key, group in enumerate(groups):
                rows = x if group is None else x[folds != group]
                z = scalers[group].apply(rows)
                norms = (z * z).sum(axis=1)
                gram = z.T @ z
                extra = np.array([len(z), (norms * norms).sum()])
                if key in acc:
                    acc[key][0] += gram
                    acc[key][1] += extra
                else:
                    acc[key] = [gram, extra]
        totals = {}
        for key, (gram, extra) in acc.items():
            totals[key, -1] = extra
            totals.update({(key, i): row for i, row in enumerate(gram)})
        if totals:
            yield sums_batch(totals)

    source = df.select(features, (F.col(fold) if fold else F.lit(-1)).alias("_fold"))
    sums = sum_by_key(few_tasks(source).mapInArrow(partial, SUM_SCHEMA))
    out = {}
    for key, group in enumerate(groups):
        d = len(scalers[group].mean)
        found = sums.get(key, {})
        n, quartic = found.get(-1, np.zeros(2))
        gram = np.array([found[i] for i in range(d)]) if found else np.zeros((d, d))
        out[group] = GramSums(int(n), gram, float(quartic))
    return out


def ledoit_wolf(sums: GramSums) -> tuple[np.ndarray, float]:
    """Shrunk covariance of centred rows and the shrinkage (Ledoit & Wolf 2004)."""
    n, p = sums.n, sums.gram.shape[0]
    cov = sums.gram / n
    if p == 1:
        return cov, 0.0
    mu = np.trace(cov) / p
    spread = (cov * cov).sum()
    beta = (sums.quartic / n - spread) / (p * n)
    delta = (spread - 2.0 * mu * np.trace(cov) + p * mu * mu) / p
    beta = min(beta, delta)
    shrink = 0.0 if beta == 0 else beta / delta
    out = (1.0 - shrink) * cov
    out[np.diag_indices(p)] += shrink * mu
    return out, float(shrink)


def covariance(sums: GramSums, use_ledoit: bool = True) -> np.ndarray:
    if use_ledoit:
        return ledoit_wolf(sums)[0]
    return sums.gram / (sums.n - 1)
