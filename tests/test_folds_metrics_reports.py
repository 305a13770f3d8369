import numpy as np
import pytest
from frames import as_dicts
from pyspark.sql import Window, functions as F

from docsignal.operators import folds, metrics, reports


def labels(spark, n=997, parts=5):
    rows = [(i, int(i % 7 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, label int").repartition(parts)


def test_rank_equals_the_global_rank(spark):
    df = labels(spark)
    order = F.md5(F.concat_ws(":", F.lit(7), F.col("doc_id")))
    plain = df.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy(order, "doc_id")))
    want = {r.r: r.doc_id for r in plain.where("label = 1").collect()}
    ranks = lambda n: F.array(F.lit(1), F.lit(2), n, n + 1, F.lit(0))
    got = folds.rank_boundaries(df, ranks, 7, "doc_id", "label")
    ones = {place: key for label, place, _, key in got if label == 1}
    assert ones == {0: want[1], 1: want[2], 2: want[max(want)]}
    split = as_dicts(folds.stratified_split(df, 0.3, seed=7))
    for label in (0, 1):
        ranked = {r.doc_id: r.r for r in plain.where(F.col("label") == label).collect()}
        first = round(0.3 * len(ranked))
        assert {k for k in ranked if split[k]["split"] == "val"} == {k for k, r in ranked.items() if r <= first}


def test_strata_are_spread_evenly_and_stable(spark):
    a = as_dicts(folds.stratified_folds(labels(spark, parts=1)))
    b = as_dicts(folds.stratified_folds(labels(spark, parts=6)))
    assert a == b
    for label in (0, 1):
        sizes = np.bincount([r["fold"] for r in a.values() if r["label"] == label])
        assert len(sizes) == 5 and sizes.max() - sizes.min() <= 1
    split = as_dicts(folds.stratified_split(labels(spark), 0.2))
    for label in (0, 1):
        members = [r["split"] for r in split.values() if r["label"] == label]
        assert abs(members.count("val") - 0.2 * len(members)) <= 1


def predictions(spark, pairs):
    return spark.createDataFrame(pairs, "y_true int, y_pred int")


def test_metrics_and_report(spark):
    df = predictions(spark, [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 3)
    m = metrics.binary_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall) == pytest.approx((0.75, 6 / 7, 0.75))
    assert m.f1 == pytest.approx(2 * 6 / (12 + 3))
    cells = {r.row: (r.pred_0, r.pred_1) for r in metrics.confusion_matrix(df).collect()}
    assert cells == {"true_0": (3, 1), "true_1": (2, 6)}
    shares = {r.row: r.pred_1 for r in metrics.confusion_matrix(df, True).collect()}
    assert shares == pytest.approx({"true_0": 0.25, "true_1": 0.75})
    rep = {r.name: r for r in metrics.class_report(df).collect()}
    assert (rep["0"].precision, rep["0"].recall, rep["0"].support) == (0.6, 0.75, 4)
    assert rep["accuracy"].f1_score == 0.75 and rep["accuracy"].precision is None
    assert rep["macro avg"].recall == 0.75
    assert rep["weighted avg"].precision == pytest.approx((0.6 * 4 + 6 / 7 * 8) / 12, abs=1e-4)


def test_undefined_metrics_are_zero(spark):
    df = predictions(spark, [(0, 0)] * 3)
    m = metrics.binary_metrics(df).first()
    assert (m.accuracy, m.f1, m.precision, m.recall) == (1.0, 0.0, 0.0, 0.0)
    assert [r.name for r in metrics.class_report(df).collect()][0] == "0"
    assert "1" not in [r.name for r in metrics.class_report(df).collect()]
    assert metrics.confusion_matrix(df, True).where("row = 'true_1'").first().pred_1 == 0.0


def test_best_points_break_ties_by_number(spark):
    trials = spark.createDataFrame(
        [(2, "union", 9, 0.9, 0.1), (1, "union", 7, 0.9, 0.2), (0, "union", 5, 0.8, 0.9)],
        "trial_number int, combine string, k int, mean_acc double, mean_f1 double",
    )
    assert reports.best_trial(trials).first().trial_number == 1
    grid = trials.withColumnRenamed("trial_number", "grid_idx")
    assert reports.best_grid_point(grid).first().mean_f1 == 0.2


def test_box_statistics(spark):
    values = [0.1, 0.5, 0.51, 0.52, 0.53, 0.54, 0.99]
    df = spark.createDataFrame([("u", i, v) for i, v in enumerate(values)], "combine string, k int, mean_acc double")
    box = reports.trial_box(df).first()
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    assert (box.q1, box.median, box.q3) == pytest.approx((q1, median, q3))
    assert (box.whisker_low, box.whisker_high, box.lowest, box.highest) == (0.5, 0.54, 0.1, 0.99)


def test_history_and_search_report(spark):
    rows = [(0, 0, 0.5, 3), (0, 1, 0.7, 4), (1, 0, 0.7, 9), (1, 1, 0.6, 2), (2, 0, 0.7, 1)]
    df = spark.createDataFrame(rows, "generation int, individual int, score double, on_count int")
    stats = as_dicts(reports.generation_stats(df), "generation")
    assert stats[0]["best_on_count"] == 4 and stats[1]["mean_score"] == pytest.approx(0.65)
    best = reports.search_report(reports.generation_stats(df), 12, "f1").first()
    assert (best.best_score, best.best_on_count, best.total_features, best.metric) == (0.7, 4, 12, "f1")


def test_summary_tables(spark):
    columns = (
        "scenario string, model string, cv_acc double, cv_f1 double, test_accuracy double, "
        "test_f1 double, test_precision double, test_recall double, model_path string"
    )
    df = spark.createDataFrame(
        [("selected_no_engineered_xgboost", "xgboost", 0.876, 0.5, 0.111, 0.2, 0.3, 0.4, "x"),
         ("other", "linear_svc", 0.1, 0.5, 0.1, 0.2, 0.3, 0.4, "y")], columns,
    )
    cv = reports.cv_table(df)
    assert cv.columns == ["scenario", "model", "CV Accuracy", "CV F1-Score"]
    assert {tuple(r) for r in cv.collect()} >= {("SNE_XGB", "xgboost", 0.88, 0.5)}
    assert reports.test_table(df).columns[2:] == ["Test Accuracy", "Test F1-Score", "Precision", "Recall"]
    assert len(reports.SHORT_NAMES) == 12
    pairs = reports.key_values(df.limit(1).select("model", "cv_acc")).collect()
    assert {p.key for p in pairs} == {"model", "cv_acc"}
    assert reports.key_values(df.limit(0)).count() == 0
    assert reports.report_head(df, ["scenario"], 1).count() == 1


def test_top_weights(spark):
    df = spark.createDataFrame([(f"f{i:02d}", float(i)) for i in range(30)], "feature string, weight double")
    top = reports.top_weights(df, 3).collect()
    assert [(r.side, r.rank, r.feature) for r in sorted(top, key=lambda r: (r.side, r.rank))] == [
        ("highest", 1, "f29"), ("highest", 2, "f28"), ("highest", 3, "f27"),
        ("lowest", 1, "f00"), ("lowest", 2, "f01"), ("lowest", 3, "f02"),
    ]
