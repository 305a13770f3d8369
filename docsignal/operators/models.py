"""Parameter grids, cross-validated search, final fits and evaluation of the four model types."""

from __future__ import annotations

import itertools
import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from docsignal.operators.boosting import BoostedModel, Boosting, fit_boosted
from docsignal.operators.folds import stratified_folds
from docsignal.operators.forest import Forest, ForestModel, fit_forest
from docsignal.operators.kernels import KernelMap, choose_basis
from docsignal.operators.matrix import Scaler, as_double_array, fit_fold_scalers, fit_scaler
from docsignal.operators.metrics import METRIC_NAMES, binary_metrics
from docsignal.operators.svm import (
    LinearModel, Task, balanced_weights, fit_linear, refit, validate_linear,
)

MODEL_TYPES = ("linear_svc", "svc_rbf", "random_forest", "xgboost")
DEEPEST_BOOSTED = 30
PARALLEL_FITS = 4
KERNEL_RANK, KERNEL_TOLERANCE = 512, 1e-4  # most basis rows of an RBF model, and the error at which fewer do
SEED = 0

# Default grids.
DEFAULT_GRIDS: dict[str, dict[str, list]] = {
    "linear_svc": {"C": [0.25, 0.5, 1.0, 2.0, 4.0]},
    "svc_rbf": {"C": [0.25, 0.5, 1.0, 2.0, 4.0], "gamma": [0.001, 0.01, 0.1, 1.0]},
    "random_forest": {
        "n_estimators": [100, 200, 300],
        "max_depth": [10, 20, None],
        "min_samples_leaf": [1, 2, 4],
    },
    "xgboost": {
        "n_estimators": [100, 200, 300],
        "max_depth": [3, 5, 7],
        "learning_rate": [0.05, 0.1, 0.2],
        "subsample": [0.8, 1.0],
    },
}


def param_grid(model_type: str, grid: Mapping[str, Sequence] | None = None) -> list[dict[str, Any]]:
    """All combinations; names in alphabetical order, the last one varying fastest."""
    if model_type not in MODEL_TYPES:
        raise ValueError(f"unknown model type {model_type!r}")
    names = sorted(DEFAULT_GRIDS[model_type])
    values = {**DEFAULT_GRIDS[model_type], **(grid or {})}
    return [dict(zip(names, point)) for point in itertools.product(*(values[n] for n in names))]


def grid_table(spark: SparkSession, points: Sequence[Mapping[str, Any]]) -> DataFrame:
    """The grid as a table: ``grid_idx`` and one DOUBLE column per parameter (NULL kept)."""
    names = list(points[0])
    rows = [
        (i, *[None if p[n] is None else float(p[n]) for n in names]) for i, p in enumerate(points)
    ]
    columns = "".join(f", `{n}` double" for n in names)
    return spark.createDataFrame(rows, f"grid_idx int{columns}")


@dataclass
class SearchResult:
    model_type: str
    points: list[dict[str, Any]]
    fold_scores: list[tuple[int, int, float, float]]  # grid_idx, fold, accuracy, f1
    class_weight: str | None = None
    best_idx: int = field(init=False)
    cv_acc: float = field(init=False)
    cv_f1: float = field(init=False)

    def __post_init__(self) -> None:
        acc = [self._mean(i, 2) for i in range(len(self.points))]
        self.best_idx = int(np.argmax(np.round(acc, 12)))  # first point wins ties
        self.cv_acc, self.cv_f1 = acc[self.best_idx], self._mean(self.best_idx, 3)

    def _mean(self, idx: int, at: int) -> float:
        return float(np.mean([s[at] for s in self.fold_scores if s[0] == idx]))

    @property
    def best_params(self) -> dict[str, Any]:
        return self.points[self.best_idx]

    def table(self, spark: SparkSession) -> DataFrame:
        """Per-fold scores joined with the parameters of the grid point."""
        scores = spark.createDataFrame(
            self.fold_scores, "grid_idx int, fold int, accuracy double, f1 double"
        )
        return scores.join(F.broadcast(grid_table(spark, self.points)), "grid_idx")


def cv_search(
    df: DataFrame,
    model_type: str = "linear_svc",
    grid: Mapping[str, Sequence] | None = None,
    n_splits: int = 5,
    seed: int = 42,
    class_weight: str | None = None,
    key: str = "doc_id",
) -> SearchResult:
    """Score every grid point by stratified k-fold accuracy and F1 of class 1.

    ``df`` is a materialised frame with ``key``, ``label`` and ``features``.
    """
    check_weight(class_weight)
    points = param_grid(model_type, grid)
    folded = df if "fold" in df.columns else stratified_folds(df, n_splits, seed, key)
    folded = as_double_array(folded).select(key, "label", "features", "fold")
    folded = folded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if model_type in ("linear_svc", "svc_rbf"):
            scores = _search_svm(folded, model_type, points, n_splits, class_weight)
        else:
            scores = _search_trees(folded, model_type, points, n_splits, class_weight)
    finally:
        folded.unpersist()
    return SearchResult(model_type, points, scores, class_weight)


def kernel_basis(df: DataFrame, scaler: Scaler, point: Mapping[str, Any]):
    """Basis rows of an RBF grid point; its ``rank`` and ``tolerance`` (0.0001) set the accuracy."""
    rank = int(point.get("rank") or KERNEL_RANK)
    return choose_basis(df, scaler, point["gamma"], rank, point.get("tolerance") or KERNEL_TOLERANCE)


def check_weight(class_weight: str | None) -> None:
    if class_weight not in (None, "balanced"):
        raise ValueError(f"class_weight must be None or 'balanced', not {class_weight!r}")


def _search_svm(folded, model_type, points, n_splits, class_weight):
    """All grid points and folds are fitted together, one data pass per Newton step.

    Basis rows of a kernel are chosen once a gamma, from all folds (labels play no part in it); they
    are scaled with each fold's own scaler.
    """
    scalers = fit_fold_scalers(folded)
    tasks, at = [], []
    bases, lifts = {}, {}
    by_fold = {
        fold: balanced_weights(folded.where(F.col("fold") != fold)) if class_weight else (1.0, 1.0)
        for fold in range(n_splits)
    }
    for idx, point in enumerate(points):
        for fold in range(n_splits):
            lift = None
            if model_type == "svc_rbf":
                gamma = point["gamma"]
                if gamma not in bases:
                    bases[gamma] = kernel_basis(folded, scalers[None], point)
                if (gamma, fold) not in lifts:
                    lifts[gamma, fold] = bases[gamma].map(scalers[fold], gamma)
                lift = lifts[gamma, fold]
            tasks.append(Task(fold=fold, c=point["C"], weights=by_fold[fold], lift=lift))
            at.append((idx, fold))
    found = validate_linear(folded, fit_linear(folded, tasks, scalers))
    return [(i, f, s["accuracy"], s["f1"]) for (i, f), s in zip(at, found)]


def _search_trees(folded, model_type, points, n_splits, class_weight):
    """Independent fits, a few submitted at a time from the driver."""
    frame = folded.persist(StorageLevel.MEMORY_AND_DISK)
    frame.count()

    def one(job: tuple[int, int]) -> tuple[int, int, float, float]:
        idx, fold = job
        train, held = frame.where(F.col("fold") != fold), frame.where(F.col("fold") == fold)
        said = fit_trees(train, model_type, points[idx], class_weight).predict(held, ())
        score = binary_metrics(said).first()
        return idx, fold, score.accuracy, score.f1

    jobs = [(i, f) for i in range(len(points)) for f in range(n_splits)]
    try:
        with ThreadPoolExecutor(PARALLEL_FITS) as pool:
            return list(pool.map(one, jobs))
    finally:
        frame.unpersist()


def tree_settings(model_type: str, point: Mapping[str, Any], seed: int = SEED) -> Forest | Boosting:
    """The settings of a grid point; trees need no scaling."""
    depth = point["max_depth"]
    if model_type == "xgboost":
        if depth is not None and int(depth) > DEEPEST_BOOSTED:
            raise ValueError(f"max_depth {depth} is beyond the deepest boosted tree ({DEEPEST_BOOSTED})")
        return Boosting(
            rounds=int(point["n_estimators"]),
            max_depth=depth,
            learning_rate=float(point["learning_rate"]),
            subsample=float(point["subsample"]),
            seed=seed,
        )
    return Forest(
        trees=int(point["n_estimators"]),
        max_depth=None if depth is None else int(depth),
        min_leaf=int(point["min_samples_leaf"]),
        seed=seed,
    )


def fit_trees(train: DataFrame, model_type: str, point: Mapping[str, Any], class_weight=None) -> ForestModel | BoostedModel:
    """Fit a forest or a booster; only the forest weighs classes."""
    settings = tree_settings(model_type, point)
    if model_type == "xgboost":
        return fit_boosted(train, settings)
    weights = balanced_weights(train) if class_weight == "balanced" else (1.0, 1.0)
    return fit_forest(train, settings, weights)


@dataclass
class FittedModel:
    """A final model of any type behind one interface."""

    model_type: str
    params: dict[str, Any]
    inner: Any

    def predict(self, df: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
        return self.inner.predict(df, keys)

    def importances(self) -> tuple[str, np.ndarray] | None:
        """``("coefficient" | "importance", values)``; a kernel model has none."""
        if isinstance(self.inner, LinearModel):
            return None if self.inner.task.lift else ("coefficient", self.inner.full_coefficients())
        return "importance", self.inner.importances()

    def weights_table(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        """``(feature, weight, kind)``; empty for a kernel model."""
        found = self.importances()
        rows = [] if found is None else [
            (n, float(v), found[0]) for n, v in zip(names, found[1], strict=True)
        ]
        return spark.createDataFrame(rows, "feature string, weight double, kind string")

    def save(self, spark: SparkSession, path: str) -> None:
        """``path/kind`` names type and parameters, ``path/model`` holds the tables of the model.

        An existing target is replaced.
        """
        kind = [(self.model_type, json.dumps(self.params))]
        kinds = spark.createDataFrame(kind, "model_type string, params string")
        kinds.coalesce(1).write.mode("overwrite").parquet(f"{path}/kind")
        if not isinstance(self.inner, LinearModel):
            self.inner.save(spark, f"{path}/model")
            return
        m = self.inner
        lift = m.task.lift
        row = (
            self.model_type, m.coefficients.tolist(), m.intercept, m.scaler.mean.tolist(),
            m.scaler.std.tolist(), m.scaler.n, float(m.task.c),
            None if m.task.columns is None else list(m.task.columns),
            None if lift is None else float(lift.gamma),
            None if lift is None else lift.pivots.tolist(),
            None if lift is None else float(lift.residual),
        )
        schema = (
            "model_type string, coefficients array<double>, intercept double, mean array<double>, "
            "std array<double>, n bigint, c double, columns array<int>, "
            "gamma double, pivots array<array<double>>, residual double"
        )
        spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> FittedModel:
    """A model that ``FittedModel.save`` wrote, of any type."""
    kind = spark.read.parquet(f"{path}/kind").first()
    params = json.loads(kind.params)
    if kind.model_type == "random_forest":
        inner = ForestModel.load(spark, f"{path}/model")
    elif kind.model_type == "xgboost":
        inner = BoostedModel.load(spark, f"{path}/model")
    else:
        inner = _load_linear(spark, f"{path}/model")
    return FittedModel(kind.model_type, params, inner)


def _load_linear(spark: SparkSession, path: str) -> LinearModel:
    r = spark.read.parquet(path).first()
    lift = None if r.pivots is None else KernelMap.on(np.array(r.pivots), r.gamma, r.residual)
    columns = None if r.columns is None else tuple(r.columns)
    return LinearModel(
        Task(columns=columns, c=r.c, lift=lift),
        Scaler(np.array(r["mean"]), np.array(r["std"]), r.n),
        np.array(r.coefficients), r.intercept, 0.0, 0.0, 0,
    )


def fit_final(
    df: DataFrame, model_type: str, params: Mapping[str, Any], class_weight: str | None = None
) -> FittedModel:
    """Fit one parameter point on all rows given (usually train + val)."""
    check_weight(class_weight)
    if model_type in ("random_forest", "xgboost"):
        return FittedModel(model_type, dict(params), fit_trees(df, model_type, params, class_weight))
    weights = balanced_weights(df) if class_weight == "balanced" else (1.0, 1.0)
    lift = None
    if model_type == "svc_rbf":
        df = as_double_array(df)
        scaler = fit_scaler(df)
        lift = kernel_basis(df, scaler, params).map(scaler, params["gamma"])
    task = Task(c=params["C"], weights=weights, lift=lift)
    return FittedModel(model_type, dict(params), refit(task, df))


def evaluate(model: FittedModel, df: DataFrame) -> dict[str, float]:
    """Accuracy, F1, precision and recall on ``df``."""
    row = binary_metrics(model.predict(df, ())).first()
    return {name: row[name] for name in METRIC_NAMES}
