"""Stratified splits and folds by the rank of a seeded hash.

A split or fold is a range of ranks within a label, so a few boundary rows per label decide it.
These are found over keys and labels alone: hash-prefix buckets are counted, and only the bucket
that holds a wanted rank is ranked row by row.  The table itself is then labelled by comparing each
row's hash with the boundaries: no join, no shuffle, no sort of texts or features.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

PREFIX_HEX = 3  # 4,096 buckets per label
MAX_LABELS = 10_000


def _hash(seed: int, key: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(key)))


def rank_boundaries(
    df: DataFrame, ranks: Callable[[Column], Column], seed: int, key: str, label: str
) -> list[tuple]:
    """``(label, place, hash, key)`` of the rows at the wanted ranks by ``md5(seed:key)`` order.

    ``ranks`` makes an array of ranks (from 1; others are ignored) of a label's number of rows.
    One row per label and rank reaches the driver.
    """
    rows = df.select(F.col(key).alias("k"), F.col(label).alias("l"), _hash(seed, key).alias("h"))
    rows = rows.withColumn("b", F.substring("h", 1, PREFIX_HEX))
    counts = rows.groupBy("l", "b").agg(F.count("*").alias("n"))
    by_label = Window.partitionBy("l")
    offsets = counts.select(
        "l", "b", "n",
        (F.sum("n").over(by_label.orderBy("b")) - F.col("n")).alias("before"),
        F.sum("n").over(by_label).alias("total"),
    )
    wanted = offsets.select("*", F.posexplode(ranks(F.col("total"))).alias("place", "rank")).where(
        "rank > before and rank <= before + n"
    )
    wanted = wanted.select(
        F.col("l").alias("wl"), F.col("b").alias("wb"), "place", (F.col("rank") - F.col("before")).alias("at")
    )
    buckets = wanted.groupBy("wl", "wb").agg(F.collect_list(F.struct("place", "at")).alias("w"))
    same = F.col("l").eqNullSafe(F.col("wl")) & (F.col("b") == F.col("wb"))
    order = Window.partitionBy("l", "b").orderBy("h", "k")
    ranked = rows.join(buckets, same).withColumn("rn", F.row_number().over(order))
    found = ranked.select("l", "h", "k", "rn", F.inline("w")).where("rn = at")
    out = [(r.l, r.place, r.h, r.k) for r in found.limit(MAX_LABELS + 1).collect()]
    if len(out) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels and boundaries")
    return out


def _after(boundary: tuple, seed: int, key: str, label: str) -> Column:
    """Whether a row of the boundary's label ranks behind it."""
    value, _, h, k = boundary
    own = _hash(seed, key)
    behind = (own > F.lit(h)) | ((own == F.lit(h)) & (F.col(key) > F.lit(k)))
    return F.col(label).eqNullSafe(F.lit(value)) & behind


def first_share(
    df: DataFrame, share: float, seed: int = 42, key: str = "doc_id", label: str = "label"
) -> Column:
    """A row expression: is the row among the first ``round(share * n)`` of its label?"""
    found = rank_boundaries(
        df, lambda n: F.array(F.round(F.lit(share) * n).cast("long")), seed, key, label
    )
    inside = [
        F.col(label).eqNullSafe(F.lit(b[0])) & ~_after(b, seed, key, label) for b in found
    ]
    return reduce(lambda a, b: a | b, inside, F.lit(False))


def stratified_split(
    df: DataFrame,
    val_size: float = 0.2,
    seed: int = 42,
    key: str = "doc_id",
    label: str = "label",
) -> DataFrame:
    """Append ``split``: the first ``round(val_size * n)`` rows of each label are ``val``."""
    is_val = first_share(df, val_size, seed, key, label)
    return df.withColumn("split", F.when(is_val, "val").otherwise("train"))


def stratified_folds(
    df: DataFrame,
    n_splits: int = 5,
    seed: int = 42,
    key: str = "doc_id",
    label: str = "label",
) -> DataFrame:
    """Append ``fold`` in ``0..n_splits-1``: equal blocks of each label's ranks."""

    def ends(n: Column) -> Column:  # the last rank of each fold but the last one
        return F.array(*(F.ceil(n * i / n_splits).cast("long") for i in range(1, n_splits)))

    found = rank_boundaries(df, ends, seed, key, label)
    behind = [_after(b, seed, key, label).cast("int") for b in found]
    fold = reduce(lambda a, b: a + b, behind, F.lit(0))
    return df.withColumn("fold", fold.cast("int"))
