"""Forests beside a plain one that tries every cut of every column a node looks at."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsignal.operators import boosting, forest
from docsignal.operators.forest import Forest, ForestModel, Rules
from frames import as_dicts
from test_boosting import data, frame


def plain_shares(x, y, keys, config, weights, cuts):
    """The share of ones that each tree gives each row, and the depth of the deepest leaf."""
    rules, deepest = Rules(config, x.shape[1], weights), 0
    out = np.zeros((config.trees, len(y)))

    def weighted(rows, times):
        return [sum(int(times[r]) for r in rows if y[r] == c) * weights[c] for c in (0, 1)]

    def purity(sides):
        return sum(a * a for a in sides) / sum(sides)

    def grow(t, rows, used, times, path, depth):
        nonlocal deepest
        deepest = max(deepest, depth)
        n = weighted(used, times)
        best = None
        if min(n) > 0 and (config.max_depth is None or depth < config.max_depth):
            for columns in (rules.columns(path), range(x.shape[1])):
                for c in columns:
                    for cut in cuts[c]:
                        left, right = [r for r in used if x[r, c] <= cut], [r for r in used if x[r, c] > cut]
                        if min(sum(times[r] for r in left), sum(times[r] for r in right)) < config.min_leaf:
                            continue
                        score = (purity(weighted(left, times)) + purity(weighted(right, times))) / sum(n)
                        if best is None or score > best[0] + 1e-9:
                            best = (score, c, cut)
                if best:
                    break
        if best is None:
            out[t, rows] = n[1] / sum(n) if sum(n) else 0
            return
        _, c, cut = best
        for side in (0, 1):
            keep = [r for r in rows if (x[r, c] > cut) == bool(side)]
            grow(t, keep, [r for r in used if (x[r, c] > cut) == bool(side)], times, forest.child_path(path, side), depth + 1)

    for t in range(config.trees):
        times = forest.copies(keys, t, config.seed)
        grow(t, list(range(len(y))), [r for r in range(len(y)) if times[r]], times, forest.root_path(config.seed, t), 0)
    return out, deepest


def answers(model, x):
    """The share of ones that each tree gives each row."""
    out, slots = np.zeros((len(model.trees), len(x))), forest._slots(model.trees, model.at)
    shards = [model.shard(i) for i in range(len(model.ends))]
    for t, tree in enumerate(model.trees):
        node = tree.nodes(x, model._thresholds(np.array(tree.feature), np.array(tree.bin)))
        place = slots[t][node] if t in slots else np.full(len(x), -1)
        out[t] = np.where(place < 0, np.array(tree.value)[node], sum(s.values(x, place) for s in shards))
    return out


def hashed(df, n):
    keys = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    return np.array([keys[i] for i in range(n)])


@pytest.mark.parametrize("config, weights, small", [
    (Forest(3, None, 1, max_bins=16), (1.0, 1.0), 1 << 20),
    (Forest(3, None, 2, max_bins=16, seed=5), (0.7, 1.9), 60 * 20),
    (Forest(2, 5, 3, columns=1, max_bins=16), (1.0, 1.0), 1),
])
def test_equals_the_plain_forest(spark, monkeypatch, config, weights, small):
    x, y = data(7, 300)
    df = frame(spark, x, y)
    monkeypatch.setattr(forest, "SMALL_BYTES", small)
    model = forest.fit_forest(df, config, weights)
    cuts = [boosting.cut_points(*boosting.merged(c, np.ones(len(c))), 16) for c in x.T]
    want, _ = plain_shares(x, y, hashed(df, len(y)), config, weights, cuts)
    assert answers(model, x) == pytest.approx(want, abs=1e-9)
    assert (sum(len(t.feature) for t in model.trees) == config.trees) == (small == 1 << 20)
    said = {r.doc_id: r.y_pred for r in model.predict(df).collect()}
    assert said == {i: int(p) for i, p in enumerate(np.round(want.mean(0), 9) > 0.5)}
    share = model.importances()
    assert share.sum() == pytest.approx(1) and share[3] == 0 and (share >= 0).all()


def test_ways_of_growing_and_shards_agree(spark, monkeypatch, tmp_path):
    x, y = data(8, 400)
    df, config = frame(spark, x, y), Forest(4, max_bins=32)
    whole = forest.fit_forest(df, config)
    monkeypatch.setattr(forest, "SMALL_BYTES", 50 * 20)
    monkeypatch.setattr(forest, "HISTOGRAM_BYTES", 1)
    monkeypatch.setattr(forest, "SHARD_BYTES", 1000)
    monkeypatch.setattr(forest, "REWRITE", 2)
    again = forest.fit_forest(df.repartition(3), config)
    assert len(whole.ends) == 1 and len(again.ends) > 2
    assert answers(again, x) == pytest.approx(answers(whole, x), abs=1e-12)
    assert again.importances() == pytest.approx(whole.importances(), abs=1e-9)
    assert as_dicts(again.predict(df)) == as_dicts(whole.predict(df))
    again.save(spark, f"{tmp_path}/m")
    back = ForestModel.load(spark, f"{tmp_path}/m")
    assert as_dicts(back.predict(df)) == as_dicts(whole.predict(df))
    assert back.importances() == pytest.approx(whole.importances(), abs=1e-9)


def test_deeper_than_thirty(spark):
    # Labels alternate along one column, so the best cut mostly takes one value off an end.
    x = np.repeat(np.arange(64.0), 12)[:, None]
    y = x[:, 0].astype(int) % 2
    df, config = frame(spark, x, y), Forest(1, seed=3)
    model = forest.fit_forest(df, config)
    want, deepest = plain_shares(x, y, hashed(df, len(y)), config, (1.0, 1.0), [np.arange(63.0)])
    assert deepest > 30
    assert answers(model, x) == pytest.approx(want, abs=1e-9)


def test_edges(spark):
    same = frame(spark, np.ones((50, 2)), np.arange(50) % 2)
    model = forest.fit_forest(same, Forest(3))
    assert model.importances().sum() == 0 and model.predict(same).count() == 50
    ones = forest.fit_forest(frame(spark, data(4, 60)[0], np.ones(60)), Forest(3))
    assert ones.predict(frame(spark, data(4, 60)[0], np.ones(60))).where("y_pred = 1").count() == 60
    assert model.predict(same.where("false")).count() == 0
    with pytest.raises(ValueError):
        forest.fit_forest(same.where("false"), Forest())
