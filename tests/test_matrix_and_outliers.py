import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from frames import as_dicts
from pyspark.sql import functions as F

from docsignal.operators import knn, matrix as M
from docsignal.operators.knn import knn_distances, knn_score
from docsignal.operators.outliers import (
    OutlierConfig, combine_flags, keep_inliers, mahalanobis_scores, removal_counts, removed_rows,
    score_outliers, sigma_flag,
)

POINTS = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 2.0]), (4, [6.0, 5.0])]


def vectors(spark, rows, parts=3):
    df = spark.createDataFrame(
        [(int(i), [float(v) for v in x]) for i, x in rows], "doc_id long, features array<double>"
    )
    return df.repartition(parts)


def brute(x, k, p=2.0, group=None):
    out = []
    for i in range(len(x)):
        d = (np.abs(x - x[i]) ** p).sum(1) ** (1 / p)
        keep = np.arange(len(x)) != i
        if group is not None:
            keep &= group == group[i]
        out.append(np.sort(d[keep])[:k])
    return out


def test_golden_scores(spark):
    df = vectors(spark, POINTS)
    lw = as_dicts(mahalanobis_scores(df))
    emp = as_dicts(mahalanobis_scores(df, use_ledoit=False))
    assert [lw[i]["md_score"] for i in range(5)] == pytest.approx(
        [1.037924, 0.810485, 0.793835, 0.370591, 2.547075], abs=1e-6
    )
    assert [emp[i]["md_score"] for i in range(5)] == pytest.approx(
        [0.795046, 1.445297, 1.001233, 1.095444, 1.754008], abs=1e-6
    )
    config = OutlierConfig(standardize=False, e_md=1.0, e_knn=1.0, k=2)
    got = as_dicts(score_outliers(df, config))
    assert [got[i]["knn_score"] for i in range(5)] == pytest.approx(
        [1.0, 1.207107, 1.207107, 1.707107, 6.451010], abs=1e-6
    )
    assert [got[i]["combined_outlier"] for i in range(5)] == [0, 0, 0, 0, 1]
    near = knn_distances(df, 2)
    kth = as_dicts(near.select("doc_id", knn_score(F.col("distances"), 2, "kth_distance").alias("s")))
    assert [kth[i]["s"] for i in range(5)] == pytest.approx(
        [1.0, 1.414214, 1.414214, 2.0, 7.071068], abs=1e-6
    )


def test_golden_shrinkage(spark):
    df = vectors(spark, POINTS)
    s = M.fit_scaler(df)
    sums = M.gram_sums(df, {None: M.Scaler(s.mean, np.ones(2), s.n)})[None]
    assert M.ledoit_wolf(sums)[1] == pytest.approx(0.865682, abs=1e-6)


@pytest.mark.parametrize("chunk_rows, p", [(4096, 2.0), (40, 2.0), (60, 1.0), (60, 3.0)])
def test_knn_is_exact_with_copies_and_clusters(spark, chunk_rows, p):
    rng = np.random.default_rng(2)
    copies = np.repeat(rng.normal(size=(1, 4)), 150, 0)  # a third of the rows are one point
    blobs = rng.normal(size=(150, 4)) * 0.1 + rng.normal(size=(5, 4)).repeat(30, 0) * 8
    x = np.concatenate([copies, blobs, rng.normal(size=(150, 4)) * [1, 1e4, 1, 1e-3]])
    got = as_dicts(knn_distances(vectors(spark, enumerate(x)), 7, p=p, chunk_rows=chunk_rows))
    assert len(got) == len(x)
    for i, want in enumerate(brute(x, 7, p)):
        assert got[i]["distances"] == pytest.approx(want, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("p", [2.0, 1.0])
def test_knn_compares_blocks_where_cells_rule_nothing_out(spark, monkeypatch, p):
    taken, by_blocks = [], knn._in_blocks
    monkeypatch.setattr(knn, "_in_blocks", lambda *a: taken.append(1) or by_blocks(*a))
    monkeypatch.setattr(knn, "CHUNK_ROWS", 60)  # several blocks of a small table
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 32))
    x[300:320] = x[0]
    x[390:] *= 1e3
    got = as_dicts(knn_distances(vectors(spark, enumerate(x)), 9, p=p, chunk_rows=20))
    assert taken and len(got) == len(x)
    for i, want in enumerate(brute(x, 9, p)):
        assert got[i]["distances"] == pytest.approx(want, rel=1e-9, abs=1e-9)
    taken.clear()
    line = np.arange(2000.0)[:, None] * [1.0, 0.5]  # here cells rule nearly all out
    near = as_dicts(knn_distances(vectors(spark, enumerate(line)), 3, p=p, chunk_rows=100))
    step = 1.25**0.5 if p == 2 else 1.5
    assert not taken and near[1000]["distances"] == pytest.approx([step, step, 2 * step])


def test_knn_blocks_by_group_with_few_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "CHUNK_ROWS", 10)
    monkeypatch.setattr(knn, "_by_blocks_is_cheaper", lambda *a: True)
    rng = np.random.default_rng(4)
    x, g = rng.normal(size=(130, 3)), np.where(np.arange(130) < 120, rng.integers(0, 2, 130), 2)
    g[129] = 3
    df = vectors(spark, enumerate(x)).join(
        spark.createDataFrame([(i, int(v)) for i, v in enumerate(g)], "doc_id long, g int"), "doc_id"
    )
    got = as_dicts(knn_distances(df, 30, group="g", chunk_rows=10))
    assert len(got) == len(x)
    for i, want in enumerate(brute(x, 30, group=g)):
        assert got[i]["distances"] == pytest.approx(want, abs=1e-12)


def test_knn_memory_does_not_follow_pivots_and_blocks():
    rng = np.random.default_rng(5)
    x, many = rng.normal(size=(10_000, 2)), rng.normal(size=(4096, 2))
    tracemalloc.start()
    cell, away = knn.nearest_pivot(x, many, 2.0)
    knn.nearest(x[:256], rng.normal(size=(200_000, 2)), 5, 2.0, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6  # 10,000 x 4,096 distances alone are 328 MB
    assert away[:50] == pytest.approx([np.sqrt(((many - row) ** 2).sum(1)).min() for row in x[:50]])


def test_knn_by_group(spark):
    rng = np.random.default_rng(4)
    x, g = rng.normal(size=(240, 3)), rng.integers(0, 3, 240)
    df = vectors(spark, enumerate(x)).join(
        spark.createDataFrame([(i, int(v)) for i, v in enumerate(g)], "doc_id long, g int"), "doc_id"
    )
    got = as_dicts(knn_distances(df, 5, group="g", chunk_rows=30))
    for i, want in enumerate(brute(x, 5, group=g)):
        assert got[i]["distances"] == pytest.approx(want, abs=1e-12)


def test_knn_edges(spark):
    assert as_dicts(knn_distances(vectors(spark, POINTS), 50))[0]["distances"][0] == 1.0
    assert all(len(r.distances) == 4 for r in knn_distances(vectors(spark, POINTS), 50).collect())
    one = knn_distances(vectors(spark, POINTS[:1]), 3)
    assert one.select(knn_score(F.col("distances"), 3).alias("s")).first().s == 0.0
    with pytest.raises(ValueError):
        knn_distances(vectors(spark, POINTS), 3, p=0.5)


def test_scalers_by_fold(spark):
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(5, 2, 90), rng.normal(1e6, 1, 90), np.full(90, 0.1)])
    fold = np.arange(90) % 3
    df = spark.createDataFrame(
        [(int(i), x[i].tolist(), int(fold[i])) for i in range(90)],
        "doc_id long, features array<double>, fold int",
    ).repartition(4)
    scalers = M.fit_fold_scalers(df)
    for f, s in scalers.items():
        part = x if f is None else x[fold != f]
        assert s.n == len(part)
        assert s.mean == pytest.approx(part.mean(0))
        assert s.std[:2] == pytest.approx(part.std(0)[:2], rel=1e-6)
        assert s.std[2] == 0.0 and s.divisor[2] == 1.0
    sums = M.gram_sums(df, scalers, fold="fold")
    for f, s in scalers.items():
        z = s.apply(x if f is None else x[fold != f])
        assert sums[f].gram == pytest.approx(z.T @ z, abs=1e-6)
        assert sums[f].quartic == pytest.approx((((z**2).sum(1)) ** 2).sum())


def test_sums_do_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 6))
    for parts in (1, 7):
        df = vectors(spark, enumerate(x), parts)
        s = M.fit_scaler(df)
        sums = M.gram_sums(df, {None: s})[None]
        z = s.apply(x)
        assert sums.n == 200 and sums.gram == pytest.approx(z.T @ z)


def test_bad_vectors_fail_and_missing_values_count_as_zero(spark):
    for bad in ([[1.0, 2.0], None], [[1.0, 2.0, 3.0], [4.0]], [[1.0, None], [2.0, 3.0]]):
        column = pa.array(bad, pa.list_(pa.float64()))
        with pytest.raises(ValueError):
            M.to_matrix(column)
    assert M.to_matrix(pa.array([[1.0, 2.0], [3.0, 4.0]])).tolist() == [[1.0, 2.0], [3.0, 4.0]]
    df = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [None, 2.0])], "id int, features array<double>")
    assert [r.features for r in M.as_double_array(df).orderBy("id").collect()] == [[1.0, 0.0], [0.0, 2.0]]


def test_one_row_and_one_column(spark):
    one = score_outliers(vectors(spark, POINTS[:1])).first()
    assert (one.md_score, one.knn_score, one.combined_outlier) == (0.0, 0.0, 0)
    column = vectors(spark, [(i, [v]) for i, v in enumerate([1.0, 2.0, 3.0, 50.0])])
    got = as_dicts(mahalanobis_scores(column, use_ledoit=False))
    assert got[3]["md_score"] > got[0]["md_score"] > 0


def test_masks_nest_and_combine(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(v), float(w)) for i, (v, w) in enumerate(rng.exponential(size=(300, 2)))]
    df = spark.createDataFrame(rows, "doc_id int, a double, b double")
    flags = sigma_flag(sigma_flag(df, "a", 1.0, "low"), "a", 2.0, "high")
    a = np.array([r[1] for r in rows])
    got = as_dicts(flags)
    for i in range(300):
        assert got[i]["high"] <= got[i]["low"]
        assert got[i]["low"] == int(a[i] > a.mean() + a.std())
    both = sigma_flag(flags, "b", 1.0, "other").select(
        combine_flags(F.col("low"), F.col("other"), "intersection").alias("i"),
        combine_flags(F.col("low"), F.col("other"), "union").alias("u"),
        combine_flags(F.col("low"), F.col("other"), "anything").alias("x"),
    )
    assert all(r.i <= r.u and r.i == r.x for r in both.collect())


def test_cleaning_never_empties_the_frame(spark):
    every = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id int, combined_outlier int")
    some = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id int, combined_outlier int")
    assert keep_inliers(every).count() == 5
    assert sorted(r.doc_id for r in keep_inliers(some).collect()) == [0, 2, 4]
    assert sorted(r.doc_id for r in removed_rows(some).collect()) == [1, 3, 5]
    counts = removal_counts(some).first()
    assert (counts.total_rows, counts.total_removed, counts.total_kept) == (6, 3, 3)


def test_blocks_grow_before_they_grow_in_number():
    """A row travels to every other block; before, 160,000 rows of 220 columns were in 16."""
    assert knn._block_counts({0: 160_000}, 220) == {0: 8}
    assert knn._block_counts({0: 960_000}, 220) == {0: 26}  # of 64 MB each
    assert set(knn._block_counts({f: 130_000 for f in range(5)}, 220).values()) == {4}
