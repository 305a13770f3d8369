"""Boosted trees beside a plain booster that tries every cut of every column of every node."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsignal.operators import boosting
from docsignal.operators.boosting import BoostedModel, Boosting, Tree


def plain_boost(x, y, keys, config, cuts):
    """Margins after every tree, nodes as lists of rows."""
    margin = np.zeros(len(y))

    def grow(rows, used, g, h, depth):
        sg, sh = g[used].sum(), h[used].sum()
        best = (1e-6, None)
        for c in range(x.shape[1]) if depth < config.depth else ():
            for cut in cuts[c]:
                left = used[x[used, c] <= cut]
                gl, hl = g[left].sum(), h[left].sum()
                if min(hl, sh - hl) < config.min_child_weight:
                    continue
                gain = gl**2 / (hl + 1) + (sg - gl) ** 2 / (sh - hl + 1) - sg**2 / (sh + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, (c, cut))
        if best[1] is None:
            margin[rows] += -config.learning_rate * sg / (sh + 1)
            return
        c, cut = best[1]
        for side in (True, False):
            grow(rows[(x[rows, c] <= cut) == side], used[(x[used, c] <= cut) == side], g, h, depth + 1)

    for t in range(config.rounds):
        p = 1 / (1 + np.exp(-margin))
        used = np.flatnonzero(boosting.in_sample(keys, t, config))
        grow(np.arange(len(y)), used, p - y, p * (1 - p), 0)
    return margin


def frame(spark, x, y):
    rows = [(i, [float(v) for v in a], int(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "doc_id long, features array<double>, label int").repartition(7)


def data(seed, n):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.exponential(size=n).round(2), np.ones(n)])
    y = (x[:, 0] + (x[:, 1] == 2) * x[:, 2] + rng.normal(scale=0.5, size=n) > 0.4).astype(int)
    return x, y


@pytest.mark.parametrize("subsample, depth", [(1.0, 3), (0.7, 2)])
def test_equals_the_plain_booster(spark, subsample, depth):
    x, y = data(1, 2000)
    config = Boosting(rounds=10, max_depth=depth, learning_rate=0.3, subsample=subsample, max_bins=32)
    df = frame(spark, x, y)
    model = boosting.fit_boosted(df, config)  # more trees than REWRITE
    keys = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    keys = np.array([keys[i] for i in range(len(y))])
    cuts = [boosting.cut_points(*boosting.merged(c, np.ones(len(c))), 32) for c in x.T]
    assert model.margins(x) == pytest.approx(plain_boost(x, y, keys, config, cuts), abs=1e-9)
    right = model.predict(df).where("y_true = y_pred").count()
    assert right == int(((model.margins(x) > 0) == (y == 1)).sum()) and right > 1600
    share = model.importances()
    assert share.sum() == pytest.approx(1) and share[3] == 0


def test_many_nodes_in_several_passes(spark, monkeypatch):
    x, y = data(2, 600)
    config = Boosting(rounds=2, max_depth=4)
    whole = boosting.fit_boosted(frame(spark, x, y), config)
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", 1)
    again = boosting.fit_boosted(frame(spark, x, y), config)
    assert [t.feature for t in whole.trees] == [t.feature for t in again.trees]
    assert whole.margins(x) == pytest.approx(again.margins(x))


def test_summaries_keep_ranks():
    rng = np.random.default_rng(3)
    x = rng.normal(size=40_000)
    values, weights = np.zeros(0), np.zeros(0)
    for part in np.array_split(x, 10):
        values, weights = boosting.merged(np.append(values, part), np.append(weights, np.ones(len(part))), 500)
    assert len(values) <= 501 and weights.sum() == len(x)
    assert (values[0], values[-1]) == (x.min(), x.max())
    ranks = np.searchsorted(np.sort(x), values, "right")
    assert np.abs(np.cumsum(weights) - ranks).max() <= 10 * len(x) / 500
    cuts = boosting.cut_points(values, weights, 16)
    assert len(cuts) == 15
    assert boosting.cut_points(np.array([1.0, 2.0]), np.ones(2), 16).tolist() == [1.0]


def test_edges(spark, tmp_path):
    same = frame(spark, np.ones((50, 2)), np.arange(50) % 2)
    model = boosting.fit_boosted(same, Boosting(rounds=2))
    assert model.margins(np.ones((1, 2)))[0] == pytest.approx(0) and model.importances().sum() == 0
    one_class = boosting.fit_boosted(frame(spark, data(4, 60)[0], np.ones(60)), Boosting(rounds=3))
    assert (one_class.margins(data(4, 60)[0]) > 0).all()
    with pytest.raises(ValueError):
        boosting.fit_boosted(same.where("false"), Boosting())
    with pytest.raises(ValueError):
        boosting.fit_boosted(same, Boosting(max_bins=1000))
    x, y = data(5, 300)
    model = boosting.fit_boosted(frame(spark, x, y), Boosting(rounds=3, max_depth=None))
    model.save(spark, f"{tmp_path}/m")
    back = BoostedModel.load(spark, f"{tmp_path}/m")
    assert back.width == 4 and (back.margins(x) == model.margins(x)).all()
    assert Tree().margins(x, False).tolist() == [0.0] * 300
