"""Report tables: distributions, trial and search summaries, best points, ranked weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from docsignal.functions.numeric import recode, round_numbers

REPORT_ROWS = 40

# Short names of scenarios and models in the report tables.
SHORT_SCENARIOS = {
    "baseline": "BL",
    "cleaned_only": "CO",
    "selected": "SEL",
    "selected_no_engineered": "SNE",
}
SHORT_MODELS = {"linear_svc": "LSVC", "random_forest": "RF", "xgboost": "XGB"}
SHORT_NAMES = {
    f"{scenario}_{model}": f"{short}_{code}"
    for model, code in SHORT_MODELS.items()
    for scenario, short in SHORT_SCENARIOS.items()
}
CV_TITLES = {"cv_acc": "CV Accuracy", "cv_f1": "CV F1-Score"}
TEST_TITLES = {
    "test_accuracy": "Test Accuracy",
    "test_f1": "Test F1-Score",
    "test_precision": "Precision",
    "test_recall": "Recall",
}


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def train_and_val(df: DataFrame) -> DataFrame:
    """Rows of the final fit."""
    return df.where(F.col("split").isin("train", "val"))


def union_splits(*splits: DataFrame) -> DataFrame:
    out = splits[0]
    for part in splits[1:]:
        out = out.unionByName(part)
    return out


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest mean accuracy; ties go to the lowest number."""
    return trials.orderBy(F.desc("mean_acc"), "trial_number").limit(1)


def best_grid_point(grid: DataFrame) -> DataFrame:
    """The grid point with the highest accuracy, F1 read at the same point; first wins ties."""
    return grid.orderBy(F.desc("mean_acc"), "grid_idx").limit(1)


def mean_over_folds(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    return scores.groupBy(*keys).agg(
        F.avg("accuracy").alias("mean_acc"), F.avg("f1").alias("mean_f1")
    )


def trials_by_combine(trials: DataFrame) -> DataFrame:
    return trials.select("combine", "trial_number", "k", "mean_acc")


def trial_box(trials: DataFrame) -> DataFrame:
    """Box statistics of the trial accuracies per combine mode; whiskers at 1.5 IQR."""
    box = trials.groupBy("combine").agg(
        F.count(F.lit(1)).alias("n_trials"),
        F.min("mean_acc").alias("lowest"),
        F.percentile("mean_acc", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
        F.max("mean_acc").alias("highest"),
        F.collect_list("mean_acc").alias("all"),  # one value per trial of a search
    )
    q1, q3 = F.col("q")[0], F.col("q")[2]
    reach = 1.5 * (q3 - q1)
    inside = F.filter("all", lambda v: v.between(q1 - reach, q3 + reach))
    return box.select(
        "combine", "n_trials", "lowest", q1.alias("q1"), F.col("q")[1].alias("median"),
        q3.alias("q3"), "highest", F.array_min(inside).alias("whisker_low"),
        F.array_max(inside).alias("whisker_high"),
    )


def generation_stats(
    population: DataFrame,
    generation: str = "generation",
    score: str = "score",
    on_count: str = "on_count",
    order: Sequence[str] = ("individual",),
) -> DataFrame:
    """Best and mean fitness and the size of the best subset, per generation.

    The first individual (by ``order``) wins ties.
    """
    first_best = F.min_by(
        F.col(on_count), F.struct((-F.col(score)).alias("_s"), *[F.col(c) for c in order])
    )
    return population.groupBy(generation).agg(
        F.max(score).alias("best_score"),
        F.avg(score).alias("mean_score"),
        first_best.alias("best_on_count"),
    )


def search_report(history: DataFrame, total_features: int, metric: str) -> DataFrame:
    """One line: best score over the history and the subset size that reached it first."""
    return history.agg(
        F.max("best_score").alias("best_score"),
        F.min_by(
            "best_on_count", F.struct((-F.col("best_score")).alias("s"), F.col("generation"))
        ).alias("best_on_count"),
    ).select(
        F.lit(metric).alias("metric"),
        "best_score",
        "best_on_count",
        F.lit(total_features).alias("total_features"),
    )


def named_weights(coefficients: DataFrame, names: DataFrame) -> DataFrame:
    """``(feature, weight)`` from one row holding a coefficient array and a table of names."""
    exploded = coefficients.select(F.posexplode("coefficients").alias("idx", "weight"))
    return exploded.join(names, "idx").select("feature", "weight")


def top_weights(weights: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` highest and the ``n`` lowest weights, ranked; ties by feature name."""
    sides = []
    for side, order in (("highest", F.desc("weight")), ("lowest", F.asc("weight"))):
        top = weights.orderBy(order, "feature").limit(n)
        rank = F.row_number().over(Window.orderBy(order, "feature"))  # at most n rows
        sides.append(top.select(F.lit(side).alias("side"), rank.alias("rank"), "feature", "weight"))
    return sides[0].unionByName(sides[1])


def report_head(df: DataFrame, order: Sequence[Column | str], n: int = REPORT_ROWS) -> DataFrame:
    """The first rows of a report table, numbers rounded to 4 decimals."""
    return round_numbers(df.orderBy(*order).limit(n), 4)


def short_summary(summary: DataFrame) -> DataFrame:
    """Experiment summary for display: short names, 2 decimals, no model path."""
    named = summary.drop("model_path").withColumn(
        "scenario", recode(F.col("scenario"), SHORT_NAMES)
    )
    return round_numbers(named, 2)


def cv_table(summary: DataFrame) -> DataFrame:
    columns = ["scenario", "model", *CV_TITLES]
    return short_summary(summary).select(*columns).withColumnsRenamed(CV_TITLES)


def test_table(summary: DataFrame) -> DataFrame:
    columns = ["scenario", "model", *TEST_TITLES]
    return short_summary(summary).select(*columns).withColumnsRenamed(TEST_TITLES)


def key_values(df: DataFrame) -> DataFrame:
    """A one-row table as ``(key, value)`` lines; an empty one gives no line, more rows fail."""
    pairs = [
        F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in df.columns
    ]
    rows = df.limit(2).agg(F.collect_list(F.array(*pairs)).alias("rows"))
    many = F.raise_error(F.lit("key_values wants one row, found more"))
    only = F.when(F.size("rows") > 1, many.cast("string"))
    lines = F.when(only.isNull(), F.try_element_at("rows", F.lit(1)))
    return rows.select(F.inline(lines))
