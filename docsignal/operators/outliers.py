"""Outlier scores, thresholds, combination and row cleaning."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as S

from docsignal.operators.knn import CHUNK_ROWS, knn_distances, knn_score
from docsignal.operators.matrix import (
    GramSums, Scaler, append_columns, as_double_array, covariance, fit_scaler, gram_sums,
    to_lists,
)
from docsignal.session import materialize


@dataclass(frozen=True)
class OutlierConfig:
    standardize: bool = True
    use_ledoit: bool = True
    ridge: float = 1e-6
    e_md: float = 2.5
    k: int = 10
    p: float = 2.0
    knn_mode: str = "avg_k_distance"
    e_knn: float = 2.0
    combine: str = "intersection"


def precision(sums: GramSums, use_ledoit: bool = True, ridge: float = 1e-6) -> np.ndarray:
    """Pseudo-inverse of the ridged covariance: d x d work on the driver (d up to about 5,000)."""
    cov = covariance(sums, use_ledoit)
    return np.linalg.pinv(cov + ridge * np.eye(len(cov)), hermitian=True)


def mahalanobis(z: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((z @ inverse) * z).sum(axis=1), 0.0))


def mahalanobis_scores(
    df: DataFrame,
    features: str = "features",
    use_ledoit: bool = True,
    ridge: float = 1e-6,
    standardize: bool = False,
    output: str = "md_score",
) -> DataFrame:
    """Append the Mahalanobis distance of each row to the mean of ``df``.

    Two scans to fit (moments, then Gram sums of centred rows), one to score.
    """
    df = as_double_array(df, features)
    scaler = fit_scaler(df, features)
    if not standardize:
        scaler = Scaler(scaler.mean, np.ones_like(scaler.mean), scaler.n)
    if scaler.n < 2:
        return df.withColumn(output, F.lit(0.0))
    sums = gram_sums(df, {None: scaler}, features)[None]
    inverse = precision(sums, use_ledoit, ridge)
    return append_columns(
        df,
        lambda x: {output: pa.array(mahalanobis(scaler.apply(x), inverse))},
        [S.StructField(output, S.DoubleType())],
        features,
    )


def sigma_flag(
    df: DataFrame, score: str, e: float | Column, output: str, group: str | None = None
) -> DataFrame:
    """Append ``score > mean + e * std_pop`` as 0/1, per group or over the whole frame."""
    at = group or "_all"
    source = df if group else df.withColumn(at, F.lit(0))
    # One line per group: bounded, and partial sums are taken before the shuffle.
    stats = source.groupBy(at).agg(F.avg(score).alias("_mu"), F.stddev_pop(score).alias("_sd"))
    width = e if isinstance(e, Column) else F.lit(float(e))
    limit = F.col("_mu") + width * F.col("_sd")
    return source.join(F.broadcast(stats), at).select(
        *df.columns, (F.col(score) > limit).cast("int").alias(output)
    )


def combine_flags(md: Column, knn: Column, mode: str | Column = "intersection") -> Column:
    """Union for mode ``"union"``; every other mode means intersection."""
    either = F.greatest(md, knn)
    both = F.least(md, knn)
    if isinstance(mode, Column):
        return F.when(mode == "union", either).otherwise(both)
    return either if mode == "union" else both


def score_outliers(
    df: DataFrame,
    config: OutlierConfig = OutlierConfig(),
    key: str = "doc_id",
    features: str = "features",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(key, md_score, knn_score, md_outlier, knn_outlier, combined_outlier)``."""
    rows = materialize(as_double_array(df.select(key, features), features), "outlier-rows")
    scaler = fit_scaler(rows, features)
    if not config.standardize:
        scaler = Scaler(scaler.mean, np.ones_like(scaler.mean), scaler.n)
    if scaler.n < 2:
        zero = [F.lit(0.0).alias(c) for c in ("md_score", "knn_score")]
        flags = [F.lit(0).alias(c) for c in ("md_outlier", "knn_outlier", "combined_outlier")]
        return rows.select(key, *zero, *flags)
    sums = gram_sums(rows, {None: scaler}, features)[None]
    inverse = precision(sums, config.use_ledoit, config.ridge)

    def scored(x: np.ndarray) -> dict[str, pa.Array]:
        z = scaler.apply(x)
        return {"_z": to_lists(z), "md_score": pa.array(mahalanobis(z, inverse))}

    fields = [
        S.StructField("_z", S.ArrayType(S.DoubleType())),
        S.StructField("md_score", S.DoubleType()),
    ]
    wide = materialize(append_columns(rows, scored, fields, features).drop(features), "outlier-md")
    near = knn_distances(wide, config.k, key, "_z", config.p, chunk_rows=chunk_rows)
    scores = wide.select(key, "md_score").join(
        near.select(key, knn_score(F.col("distances"), config.k, config.knn_mode).alias("knn_score")),
        key,
    )
    return flag_outliers(materialize(scores, "outlier-scores"), config)


def flag_outliers(scores: DataFrame, config: OutlierConfig) -> DataFrame:
    """Threshold both scores and combine the flags."""
    flagged = sigma_flag(
        sigma_flag(scores, "md_score", config.e_md, "md_outlier"),
        "knn_score", config.e_knn, "knn_outlier",
    )
    combined = combine_flags(F.col("md_outlier"), F.col("knn_outlier"), config.combine)
    return flagged.withColumn("combined_outlier", combined)


def keep_inliers(df: DataFrame, flag: str = "combined_outlier", group: str | None = None) -> DataFrame:
    """Drop flagged rows; if that would leave a group empty, keep all of it."""
    at = group or "_all"
    source = df if group else df.withColumn(at, F.lit(0))
    emptied = source.groupBy(at).agg((F.min(flag) == 1).alias("_emptied"))
    return (
        source.join(F.broadcast(emptied), at)
        .where((F.col(flag) == 0) | F.col("_emptied"))
        .select(*df.columns)
    )


def removed_rows(scored: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys of the flagged rows."""
    return scored.where(F.col("combined_outlier") == 1).select(key)


def removal_counts(scored: DataFrame) -> DataFrame:
    """``(total_rows, total_removed, total_kept)``."""
    removed = F.count_if(F.col("combined_outlier") == 1)
    total = F.count(F.lit(1))
    return scored.agg(
        total.alias("total_rows"),
        removed.alias("total_removed"),
        (total - removed).alias("total_kept"),
    )
