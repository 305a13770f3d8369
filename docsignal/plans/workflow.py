"""The steps put together: corpus -> features -> outliers -> models -> experiment table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from docsignal.functions import text as T
from docsignal.operators import metrics
from docsignal.operators.folds import first_share
from docsignal.operators.frame import FeatureModel, fit_features, mask_array
from docsignal.operators.metrics import METRIC_NAMES
from docsignal.operators.models import FittedModel, cv_search, evaluate, fit_final
from docsignal.operators.outliers import OutlierConfig, keep_inliers, score_outliers
from docsignal.operators.selection import Breeding, Scoring, search_subset
from docsignal.operators.tfidf import TfidfConfig
from docsignal.operators.tuning import Trial, clean_with, random_trials, tune_outliers
from docsignal.session import materialize
from docsignal.sources import sinks, tables

SUMMARY_SCHEMA = (
    "scenario string, model string, cv_acc double, cv_f1 double, "
    + ", ".join(f"test_{m} double" for m in METRIC_NAMES)
    + ", model_path string"
)


@dataclass
class Prepared:
    """A featurised corpus: one keyed frame with ``split``, written once."""

    frame: DataFrame  # doc_id, label, split, features
    model: FeatureModel

    @property
    def names(self) -> list[str]:
        return self.model.names

    def split(self, *names: str) -> DataFrame:
        return self.frame.where(F.col("split").isin(*names))


def assign_splits(
    corpus: DataFrame, val_size: float = 0.2, test_size: float = 0.0, seed: int = 42
) -> DataFrame:
    """Append ``split``: ``train``/``val``, after setting a ``test`` share aside if asked.

    Boundaries are found over keys and labels; the split is then an expression over each row.
    """
    keys = corpus.select("doc_id", "label")
    is_test = None
    if test_size:
        is_test = first_share(keys, test_size, seed + 1)
        keys = keys.where(~is_test)
    split = F.when(first_share(keys, val_size, seed), "val").otherwise("train")
    if is_test is not None:
        split = F.when(is_test, "test").otherwise(split)
    return corpus.withColumn("split", split)


def prepare(
    corpus: DataFrame,
    config: TfidfConfig = TfidfConfig(),
    lexicon: Mapping[str, float] | None = None,
) -> Prepared:
    """Fit on the train rows of ``(doc_id, text, label, split)``, featurise all rows."""
    corpus = corpus.select("doc_id", "text", "label", "split")
    model = fit_features(corpus.where(F.col("split") == "train"), config, lexicon)
    return Prepared(materialize(model.transform(corpus), "features"), model)


def cleaned_corpus(
    corpus: DataFrame, config: OutlierConfig = OutlierConfig(), tfidf: TfidfConfig = TfidfConfig()
) -> DataFrame:
    """Labelled corpus -> train rows without outliers: ``(doc_id, label, md_score, knn_score)``."""
    prepared = prepare(assign_splits(corpus), tfidf)
    train = prepared.split("train")
    scored = score_outliers(train, config)
    kept = keep_inliers(scored).select("doc_id", "md_score", "knn_score")
    return train.select("doc_id", "label").join(kept, "doc_id")


def select_features(frame: DataFrame, mask: Sequence[bool]) -> DataFrame:
    return frame.withColumn("features", mask_array(F.col("features"), mask))


def train_and_judge(
    prepared: Prepared,
    model_type: str,
    grid: Mapping[str, Sequence] | None = None,
    n_splits: int = 5,
    seed: int = 42,
    class_weight: str | None = None,
    final_on_val_too: bool = True,
) -> tuple[FittedModel, DataFrame]:
    """Search on train, fit, and one metric line per (fit, judged rows).

    ``val_held_out`` judges the fit on train alone; ``val_in_sample`` judges the final fit, which
    has seen those rows when it includes them.
    """
    spark = prepared.frame.sparkSession
    train, val, test = (prepared.split(s) for s in ("train", "val", "test"))
    found = cv_search(train, model_type, grid, n_splits, seed, class_weight)
    first = fit_final(train, model_type, found.best_params, class_weight)
    lines = [("val_held_out", evaluate(first, val))]
    final = first
    if final_on_val_too:
        both = prepared.split("train", "val")
        final = fit_final(both, model_type, found.best_params, class_weight)
        lines.append(("val_in_sample", evaluate(final, val)))
    lines.append(("test", evaluate(final, test)))
    rows = [
        (model_type, judged, found.cv_acc, found.cv_f1, *[scores[m] for m in METRIC_NAMES])
        for judged, scores in lines
    ]
    schema = "model string, judged string, cv_acc double, cv_f1 double, " + ", ".join(
        f"{m} double" for m in METRIC_NAMES
    )
    return final, spark.createDataFrame(rows, schema)


def save_evaluation(model: FittedModel, test: DataFrame, path: str) -> None:
    """Model, metrics, class report, predictions and both confusion matrices under ``path``."""
    spark = test.sparkSession
    model.save(spark, f"{path}/model")
    sinks.write_csv(model.predict(test), f"{path}/predictions")
    # What is judged is what was written; predictions are not computed again.
    said = tables.read_csv(
        spark, f"{path}/predictions", "doc_id string, y_true int, y_pred int"
    )
    named = metrics.binary_metrics(said).withColumnsRenamed({m: f"test_{m}" for m in METRIC_NAMES})
    sinks.write_json(named, f"{path}/metrics")
    sinks.write_csv(metrics.class_report(said), f"{path}/report")
    sinks.write_csv(metrics.confusion_matrix(said), f"{path}/confusion")
    sinks.write_csv(metrics.confusion_matrix(said, True), f"{path}/confusion_normalized")


def run_scenario(
    scenario: str,
    model_type: str,
    train: DataFrame,
    val: DataFrame,
    test: DataFrame,
    grid: Mapping[str, Sequence] | None = None,
    n_splits: int = 5,
    seed: int = 42,
    path: str | None = None,
) -> tuple[tuple, FittedModel]:
    """Search on train, refit on train + val, judge on test: one summary row and the model."""
    found = cv_search(train, model_type, grid, n_splits, seed)
    final = fit_final(train.unionByName(val), model_type, found.best_params)
    scores = evaluate(final, test)
    if path:
        final.save(train.sparkSession, path)
    row = (
        f"{scenario}_{model_type}", model_type, found.cv_acc, found.cv_f1,
        *[scores[m] for m in METRIC_NAMES], path or "",
    )
    return row, final


def experiment_suite(
    prepared: Prepared,
    trial: Trial,
    mask: Sequence[bool],
    grids: Mapping[str, Mapping[str, Sequence]],
    n_splits: int = 5,
    seed: int = 42,
    drop_engineered: bool = True,
    out_dir: str | None = None,
) -> tuple[DataFrame, dict[str, FittedModel]]:
    """Scenario x model table; ``grids`` names the model types to run.

    Scenarios share one written frame: cleaning filters its rows, selection its array positions.
    """
    spark = prepared.frame.sparkSession
    train, val, test = (prepared.split(s).drop("split") for s in ("train", "val", "test"))
    cleaned = materialize(clean_with(train, trial), "cleaned")
    without = [bit and n not in T.ENGINEERED_NAMES for bit, n in zip(mask, prepared.names)]
    scenarios = {"baseline": (train, None), "cleaned_only": (cleaned, None)}
    scenarios["selected"] = (cleaned, list(mask))
    if drop_engineered and any(without):
        scenarios["selected_no_engineered"] = (cleaned, without)
    rows, models = [], {}
    for model_type, grid in grids.items():
        for name, (rows_in, bits) in scenarios.items():
            parts = [rows_in, val, test]
            if bits is not None:
                parts = [select_features(p, bits) for p in parts]
            at = f"{out_dir.rstrip('/')}/{name}_{model_type}" if out_dir else None
            row, model = run_scenario(name, model_type, *parts, grid, n_splits, seed, at)
            rows.append(row)
            models[row[0]] = model
    return spark.createDataFrame(rows, SUMMARY_SCHEMA), models


def full_study(
    corpus: DataFrame,
    grids: Mapping[str, Mapping[str, Sequence]],
    trials: Sequence[Trial] | None = None,
    breeding: Breeding = Breeding(),
    scoring: Scoring = Scoring(),
    tfidf: TfidfConfig = TfidfConfig(),
    test_size: float = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, dict[str, FittedModel]]:
    """Everything in order: split, featurise, tune cleaning, search a subset, compare models."""
    prepared = prepare(assign_splits(corpus, test_size=test_size, seed=seed), tfidf)
    train = prepared.split("train")
    tuned = tune_outliers(train, trials or random_trials(seed=seed), scoring.n_splits, seed)
    cleaned = materialize(clean_with(train.drop("split"), tuned.best), "study-clean")
    outcome = search_subset(cleaned, breeding, scoring)
    return experiment_suite(
        prepared, tuned.best, [bool(b) for b in outcome.mask], grids, scoring.n_splits, seed
    )
