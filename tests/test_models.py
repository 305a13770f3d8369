import numpy as np
import pytest
from frames import as_dicts
from pyspark.sql import functions as F

from docsignal.operators import matrix as M
from docsignal.operators import models, svm, tuning
from docsignal.operators.folds import stratified_folds
from docsignal.operators.knn import knn_distances, knn_score
from docsignal.operators.outliers import OutlierConfig, score_outliers
from docsignal.operators.selection import Breeding, Scoring, SubsetFitness, _offspring, _repair, search_subset
from docsignal.session import materialize


def points(n=240, d=5, seed=0):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.4).astype(int)
    x = rng.normal(size=(n, d)) * [1, 5, 0.1, 1, 1][:d] + y[:, None] * np.array([1.5, 4, 0, 0, 0])[:d]
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(int(i), int(t), [float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "doc_id long, label int, features array<double>")
    return df.repartition(parts)


def optimum_gap(model, x, y, c, weights=(1.0, 1.0), columns=None):
    """Largest entry of the objective's gradient at the fitted weights, by plain numpy."""
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    z = z if columns is None else z[:, columns]
    a = np.hstack([z, np.ones((len(z), 1))])
    s = np.where(y == 1, 1, -1)
    w = np.append(model.coefficients, model.intercept)
    cost = c * np.where(y == 1, weights[1], weights[0])
    slack = np.maximum(0, 1 - s * (a @ w))
    return np.abs(w - 2 * a.T @ (cost * s * slack)).max()


def test_svm_reaches_the_optimum(spark):
    x, y = points()
    df = frame(spark, x, y)
    tasks = [
        svm.Task(c=1.0), svm.Task(c=0.25, weights=(0.7, 2.0)), svm.Task(c=4.0, columns=(0, 1, 4)),
    ]
    fitted = svm.fit_linear(df, tasks)
    assert optimum_gap(fitted[0], x, y, 1.0) < 1e-3
    assert optimum_gap(fitted[1], x, y, 0.25, (0.7, 2.0)) < 1e-3
    assert optimum_gap(fitted[2], x, y, 4.0, columns=[0, 1, 4]) < 1e-3
    said = as_dicts(fitted[0].predict(df))
    assert all(said[i]["y_pred"] == int(m > 0) for i, m in enumerate(fitted[0].margins(x)))
    assert np.mean([r["y_pred"] == r["y_true"] for r in said.values()]) > 0.85
    assert fitted[2].full_coefficients()[2] == 0.0


def test_svm_same_result_for_any_batching(spark, monkeypatch):
    x, y = points(seed=3)
    df = stratified_folds(frame(spark, x, y, 4), 3)
    tasks = [svm.Task(fold=f, c=c) for f in range(3) for c in (0.5, 2.0)]
    small = svm.fit_linear(df, tasks)
    scores = svm.validate_linear(df, small)
    monkeypatch.setattr(svm, "BATCH_BYTES", 700)  # two models per batch
    large = svm.fit_linear(df, tasks)
    for a, b in zip(small, large):
        assert a.coefficients == pytest.approx(b.coefficients, abs=1e-5)
    assert svm.validate_linear(df, large) == scores


def test_svm_leaves_out_fold_and_dropped_rows(spark):
    x, y = points(seed=5)
    df = stratified_folds(frame(spark, x, y), 4)
    scalers = M.fit_fold_scalers(df)
    gone = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    fitted = svm.fit_linear(
        df.withColumn("dropped", gone), [svm.Task(fold=2), svm.Task(fold=2)], scalers
    )
    fold = np.array([r.fold for r in df.orderBy("doc_id").collect()])
    for model, keep in ((fitted[0], fold != 2), (fitted[1], (fold != 2) & (np.arange(240) % 3 != 0))):
        z = scalers[2].apply(x[keep])
        a = np.hstack([z, np.ones((len(z), 1))])
        s = np.where(y[keep] == 1, 1, -1)
        w = np.append(model.coefficients, model.intercept)
        assert np.abs(w - 2 * a.T @ (s * np.maximum(0, 1 - s * (a @ w)))).max() < 1e-3


def test_kernel_features_separate_circles(spark):
    rng = np.random.default_rng(1)
    angle, y = rng.uniform(0, 2 * np.pi, 300), (np.arange(300) % 2)
    x = np.column_stack([np.cos(angle), np.sin(angle)]) * (1 + 2 * y)[:, None]
    df = frame(spark, x, y)
    linear = models.evaluate(models.fit_final(df, "linear_svc", {"C": 1.0}), df)
    kernel = models.fit_final(df, "svc_rbf", {"C": 1.0, "gamma": 0.5})
    assert models.evaluate(kernel, df)["accuracy"] > 0.95 > linear["accuracy"] + 0.2
    assert kernel.importances() is None and kernel.weights_table(spark, ["a", "b"]).count() == 0
    z = rng.normal(size=(40, 2))
    lift = svm.FourierMap.draw(2, 0.5, 20_000).apply(z)
    exact = np.exp(-0.5 * ((z[:, None] - z[None]) ** 2).sum(2))
    assert np.abs(lift @ lift.T - exact).max() < 0.06


def test_grid_order_and_ties(spark):
    points_ = models.param_grid("random_forest", {"n_estimators": [1, 2], "max_depth": [3, None], "min_samples_leaf": [1]})
    assert [(p["max_depth"], p["n_estimators"]) for p in points_] == [(3, 1), (3, 2), (None, 1), (None, 2)]
    assert len(models.param_grid("linear_svc")) == 5 and len(models.param_grid("svc_rbf")) == 20
    assert len(models.param_grid("random_forest")) == 27 and len(models.param_grid("xgboost")) == 54
    table = models.grid_table(spark, points_)
    assert table.where("max_depth IS NULL").count() == 2
    tied = models.SearchResult("linear_svc", [{"C": 1.0}, {"C": 2.0}], [(0, 0, 0.5, 0.1), (1, 0, 0.5, 0.9)])
    assert tied.best_params == {"C": 1.0} and tied.cv_f1 == 0.1
    with pytest.raises(ValueError):
        models.param_grid("nonsense")


def test_search_fit_save_and_load(spark, tmp_path):
    x, y = points(160, seed=8)
    df = frame(spark, x, y, 2)
    found = models.cv_search(df, "linear_svc", {"C": [0.5, 1.0]}, n_splits=3)
    assert found.cv_acc > max(y.mean(), 1 - y.mean())
    assert found.table(spark).count() == 6
    balanced = models.cv_search(df, "linear_svc", {"C": [1.0]}, 3, class_weight="balanced")
    assert balanced.cv_f1 > 0.7
    model = models.fit_final(df, "linear_svc", found.best_params)
    path = str(tmp_path / "svm")
    model.save(spark, path)
    model.save(spark, path)
    again = models.load_model(spark, path)
    assert as_dicts(again.predict(df)) == as_dicts(model.predict(df))
    kind, weights = model.importances()
    assert kind == "coefficient" and abs(weights[0]) > abs(weights[3])


@pytest.mark.parametrize("kind, grid", [
    ("random_forest", {"n_estimators": [5], "max_depth": [4, None], "min_samples_leaf": [1]}),
    ("xgboost", {"n_estimators": [3], "max_depth": [3], "learning_rate": [0.2], "subsample": [1.0]}),
])
def test_tree_models(spark, kind, grid, tmp_path):
    x, y = points(160, seed=9)
    df = frame(spark, x, y, 2)
    found = models.cv_search(df, kind, grid, n_splits=2)
    model = models.fit_final(df, kind, found.best_params, class_weight="balanced")
    scores = models.evaluate(model, df)
    assert scores["accuracy"] > max(y.mean(), 1 - y.mean())
    importance = model.weights_table(spark, [f"c{i}" for i in range(5)]).orderBy(F.desc("weight")).first()
    assert importance.kind == "importance" and importance.feature in ("c0", "c1")
    model.save(spark, str(tmp_path / "trees"))
    again = models.load_model(spark, str(tmp_path / "trees"))
    assert again.model_type == kind and again.params == model.params
    assert as_dicts(again.predict(df)) == as_dicts(model.predict(df))
    if kind == "xgboost":
        with pytest.raises(ValueError):
            models.tree_settings(kind, {**model.params, "max_depth": 31})
    else:  # a forest has no deepest tree
        assert models.tree_settings(kind, {**model.params, "max_depth": 310}).max_depth == 310
    with pytest.raises(ValueError):
        models.fit_final(df, kind, model.params, class_weight="heavy")


# --- outlier tuning ---------------------------------------------------------------------------


def test_fold_scores_equal_scoring_each_training_fold_alone(spark):
    x, y = points(90, seed=11)
    df = stratified_folds(frame(spark, x, y), 3)
    shared = tuning.fold_scores(df, 6).collect()
    for f in range(3):
        alone = score_outliers(df.where(F.col("fold") != f), OutlierConfig(k=6))
        want = as_dicts(alone)
        mine = [r for r in shared if r.train_fold == f]
        assert {r.doc_id for r in mine} == set(want)
        for r in mine:
            assert r.md_score == pytest.approx(want[r.doc_id]["md_score"])
            assert np.mean(r.distances) == pytest.approx(want[r.doc_id]["knn_score"])


def test_trial_flags_equal_the_single_strategy(spark):
    x, y = points(120, seed=12)
    df = frame(spark, x, y)
    trials = [tuning.Trial(1.5, 1.0, 5), tuning.Trial(1.2, 0.8, 9, "union", "kth_distance")]
    scored = score_outliers(df, OutlierConfig(k=9)).select("doc_id", "md_score")
    scaled = M.scale(df, M.fit_scaler(df))
    flagged = tuning.trial_flags(scored.join(knn_distances(scaled, 9), "doc_id"), trials)
    rows = tuning.trial_rows(flagged, trials, ["doc_id"]).collect()
    for number, t in enumerate(trials):
        config = OutlierConfig(e_md=t.e_md, e_knn=t.e_knn, k=t.k, combine=t.combine, knn_mode=t.knn_score)
        want = as_dicts(score_outliers(df, config))
        for r in rows:
            if r.trial_number == number:
                assert r.combined_outlier == want[r.doc_id]["combined_outlier"]
                assert r.md_outlier == want[r.doc_id]["md_outlier"]
                assert r.knn_outlier == want[r.doc_id]["knn_outlier"]


def test_a_trial_that_flags_everything_drops_nothing(spark):
    rows = [(i, i % 2, [1, 0] if i % 2 else [1, 1]) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id int, g int, flags array<int>")
    got = as_dicts(tuning.unless_all(df, 2, "g"))
    assert all(got[i]["flags"] == ([0, 0] if i % 2 else [0, 0]) for i in range(8))
    mixed = spark.createDataFrame([(0, 0, [1, 1]), (1, 0, [1, 0])], "doc_id int, g int, flags array<int>")
    assert [r.flags for r in tuning.unless_all(mixed, 2, "g").orderBy("doc_id").collect()] == [[0, 1], [0, 0]]


def test_tuning_is_repeatable_and_never_reads_validation_rows(spark):
    x, y = points(120, seed=13)
    x[:4] += 40  # gross outliers
    df = frame(spark, x, y)
    trials = tuning.random_trials(5, k=(3, 8))
    assert trials == tuning.random_trials(5, k=(3, 8))
    assert all(1.5 <= t.e_md <= 4.0 and 3 <= t.k <= 8 for t in trials)
    first = tuning.tune_outliers(df, trials, n_splits=3)
    assert first == tuning.tune_outliers(df.repartition(1), trials, n_splits=3)
    assert first.table(spark).count() == 5 and first.report(spark).count() == 1
    assert first.mean_acc[first.best_idx] == max(first.mean_acc)
    # The same trial, fold by fold, with plain numpy.
    folded = stratified_folds(df, 3).orderBy("doc_id").collect()
    fold = np.array([r.fold for r in folded])
    accuracies = []
    for f in range(3):
        train = df.join(spark.createDataFrame([(i,) for i in np.nonzero(fold != f)[0].tolist()], "doc_id long"), "doc_id")
        t = trials[0]
        config = OutlierConfig(e_md=t.e_md, e_knn=t.e_knn, k=t.k, combine=t.combine, knn_mode=t.knn_score)
        flags = as_dicts(score_outliers(train, config))
        keep = np.array([fold[i] != f and not flags[i]["combined_outlier"] for i in range(120)])
        tr = x[fold != f]
        z = (x - tr.mean(0)) / tr.std(0)
        model = svm.fit_linear(
            frame(spark, z[keep], y[keep]), [svm.Task()], {None: M.Scaler.identity(5, int(keep.sum()))}
        )[0]
        held = fold == f
        said = z[held] @ model.coefficients + model.intercept > 0
        accuracies.append((said == (y[held] == 1)).mean())
    assert first.mean_acc[0] == pytest.approx(np.mean(accuracies))


def test_clean_with_drops_gross_outliers(spark):
    x, y = points(120, seed=14)
    x[:3] += 50
    kept = tuning.clean_with(frame(spark, x, y), tuning.Trial(2.0, 2.0, 5))
    assert {0, 1, 2}.isdisjoint(r.doc_id for r in kept.collect())


# --- subset search -----------------------------------------------------------------------------


def test_genetic_steps_keep_their_invariants():
    rng = np.random.default_rng(0)
    masks = _repair(rng.random((9, 30)) < 0.05, 7, rng)
    assert masks.sum(1).min() >= 7
    sparse = rng.random((4, 10)) < 0.3
    assert (_repair(sparse, 0, rng) == sparse).all() and (_repair(sparse, 5, rng) >= sparse).all()
    config = Breeding(pop_size=9, min_features=7, mutation_prob=0.0, crossover_prob=0.0)
    children = _offspring(masks, np.arange(9.0), config, rng)
    assert children.shape == (8, 30)
    parents = {m.tobytes() for m in masks}
    assert all(c.tobytes() in parents for c in children)  # plain copies without mixing


def test_subset_fitness_equals_a_search_on_the_subset(spark):
    x, y = points(150, seed=15)
    df = frame(spark, x, y)
    config = Scoring(n_splits=3)
    fitness = SubsetFitness(df, config)
    mask = np.array([True, False, False, True, True])
    cut = frame(spark, x[:, mask], y)
    want = models.cv_search(cut, "linear_svc", {"C": [1.0]}, 3).cv_acc
    values = fitness(np.array([mask, np.zeros(5, bool), mask]))
    assert values == pytest.approx([want, 0.0, want])
    assert len(fitness.known) == 1
    fitness.close()


def test_search_is_repeatable_and_monotone(spark):
    x, y = points(120, seed=16)
    df = frame(spark, x, y)
    config, scoring = Breeding(pop_size=4, generations=3, min_features=2, mutation_prob=0.2), Scoring(n_splits=2)
    a, b = search_subset(df, config, scoring), search_subset(df, config, scoring)
    assert (a.mask == b.mask).all() and a.history == b.history
    best = [h[1] for h in a.history]
    assert best == sorted(best) and a.score == best[-1]
    assert a.mask.sum() >= 2 and len(a.selected(list("abcde"))) == a.mask.sum()
    assert a.report(spark).first().best_score == pytest.approx(a.score)
    stopped = search_subset(df, Breeding(pop_size=2, generations=9, min_features=99, early_stop_patience=2), scoring)
    assert stopped.mask.all() and len(stopped.history) == 3


def test_score_of_sorted_distances(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 6.0])], "doc_id int, distances array<double>")
    row = df.select(
        knn_score(F.col("distances"), 2).alias("a"),
        knn_score(F.col("distances"), 3, "kth_distance").alias("b"),
        knn_score(F.col("distances"), 9).alias("c"),
    ).first()
    assert tuple(row) == (1.5, 6.0, 3.0)


def test_line_search_sums_give_the_slopes_of_the_objective():
    rng = np.random.default_rng(3)
    z, y = rng.normal(size=(400, 6)), np.where(rng.random(400) < 0.5, 1.0, -1.0)
    base, step, cost = rng.normal(size=6), 3 * rng.normal(size=6), rng.random(400)
    cost[::50], z[::40] = 0.0, 0.0
    slack, gain = 1 - y * (z @ base), y * (z @ step)
    slopes = svm._slopes(base, step, svm._turns(slack, gain, cost))
    for t, slope in zip(svm.EDGES, slopes):
        w = base + t * step
        left = np.maximum(slack - t * gain, 0)
        assert slope == pytest.approx(w @ step - 2 * (cost * gain * left).sum(), rel=1e-9, abs=1e-7)
    value = lambda t: 0.5 * ((base + t * step) ** 2).sum() + (cost * np.maximum(slack - t * gain, 0) ** 2).sum()
    best = svm._lowest_in_memory(base @ step, step @ step, slack, gain, cost)
    around = [value(t) for t in np.linspace(0, 3 * best + 1, 400)]
    assert value(best) <= min(around) + 1e-9
    if 0 < best < 1:
        assert value(svm._lowest(slopes)) <= value(best) * 1.01


def test_starts_and_the_path_of_c_leave_the_optimum_and_save_passes(spark, monkeypatch):
    x, y = points(900, seed=12)
    df = stratified_folds(frame(spark, x, y, 3), 3, 42, "doc_id")
    tasks = [svm.Task(fold=f, c=c) for f in range(3) for c in (0.25, 1.0, 16.0)]
    passes = []
    sums = svm._step_sums
    monkeypatch.setattr(svm, "_step_sums", lambda *a: passes.append(len(a[1])) or sums(*a))
    whole = svm.fit_linear(df, tasks)
    assert passes == [9]  # the sample is the whole table: one pass confirms it
    passes.clear()
    monkeypatch.setattr(svm, "SAMPLE_ROWS", 60)
    part = svm.fit_linear(df, tasks)
    assert 1 < len(passes) <= 30
    for a, b in zip(whole, part):
        assert a.coefficients == pytest.approx(b.coefficients, abs=1e-4)
        assert a.intercept == pytest.approx(b.intercept, abs=1e-4)


def test_a_better_optimum_of_a_smaller_c_is_taken_over():
    ended = svm._State(np.zeros(2), np.array([1.0, 0.0]), np.zeros(2), loss=2.0, done=True)
    going = svm._State(np.array([5.0, 5.0]), np.array([5.0, 5.0]), np.ones(2), value=9.0)
    svm._offer(ended, going, 5.0)  # 0.5 + 10
    assert going.weights.tolist() == [5.0, 5.0]
    svm._offer(ended, going, 2.0)
    assert going.weights.tolist() == [1.0, 0.0] and not going.pending.any()


def test_passes_leave_no_shuffle_files(spark):
    """Before, every pass of a fit left its sums on disk until the driver collected garbage."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: sum(str(f).endswith(".data") for f in blocks.getAllFiles().mkString("\n").split("\n"))
    rows = spark.range(0, 40, 1, 4).selectExpr("cast(id % 3 as int) key", "0 row", "array(double(id)) total")
    before = files()
    for _ in range(20):
        sums = M.sum_by_key(rows)
        assert {k: v[0][0] for k, v in sums.items()} == {0: 273.0, 1: 247.0, 2: 260.0}
    assert files() < before + 10


def test_one_file_of_rows_is_fitted_by_several_tasks(spark, monkeypatch):
    """Before, rows in one file were all fitted by one task, however many they were."""
    monkeypatch.setattr(svm, "TASK_ROWS", 100)
    rows = spark.range(0, 400, 1, 1).selectExpr("id doc_id", "array(rand(1), rand(2)) features", "int(id % 2) label")
    rows = materialize(rows, "one-file")
    seen, step = [], svm._step_sums
    monkeypatch.setattr(svm, "_step_sums", lambda r, *a: seen.append(r.rdd.getNumPartitions()) or step(r, *a))
    svm.fit_linear(rows, [svm.Task()])
    assert set(seen) == {4}


def test_curvature_is_a_product_of_a_matrix_with_itself():
    """Before, both halves of every curvature were computed, and differed in their last digits."""
    rng = np.random.default_rng(3)
    rows, cost = rng.normal(size=(500, 37)), rng.uniform(0, 2, 500)
    curve = svm._curvature(rows, cost)
    assert np.allclose(curve, 2.0 * np.einsum("ni,n,nj->ij", rows, cost, rows))
    assert (curve == curve.T).all()
    assert (svm._curvature(rows[:0], cost[:0]) == np.zeros((37, 37))).all()
