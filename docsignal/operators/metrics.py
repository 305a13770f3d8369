"""Classification metrics over any ``(y_true, y_pred)`` table, one aggregate each.

All of them accept grouping columns; a quotient with a zero denominator is 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

METRIC_NAMES = ["accuracy", "f1", "precision", "recall"]


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _binary(name: str) -> Column:
    """A label column; anything but 0 or 1 fails, since it would leave the denominators unseen."""
    message = F.concat(F.lit(f"{name} must be 0 or 1, found "), F.coalesce(F.col(name).cast("string"), F.lit("NULL")))
    return F.when(F.col(name).isin(0, 1), F.col(name)).otherwise(F.raise_error(message))


def _cells(df: DataFrame, group: Sequence[str], also: Sequence[Column] = ()) -> DataFrame:
    """Counts of the four binary cells: ``c_tp`` is true label t, predicted p."""
    df = df.withColumns({c: _binary(c) for c in ("y_true", "y_pred")})
    return df.groupBy(*group).agg(
        *also,
        *[
            F.count_if((F.col("y_true") == t) & (F.col("y_pred") == p)).alias(f"c_{t}{p}")
            for t in (0, 1)
            for p in (0, 1)
        ]
    )


def binary_metrics(
    df: DataFrame, group: Sequence[str] = (), also: Mapping[str, Column] | None = None
) -> DataFrame:
    """Accuracy, and F1, precision and recall of class 1; ``also`` adds named aggregates."""
    also = also or {}
    c = {k: F.col(f"c_{k}") for k in ("00", "01", "10", "11")}
    total = c["00"] + c["01"] + c["10"] + c["11"]
    return _cells(df, group, [a.alias(name) for name, a in also.items()]).select(
        *group,
        *also,
        _share(c["00"] + c["11"], total).alias("accuracy"),
        _share(2 * c["11"], 2 * c["11"] + c["01"] + c["10"]).alias("f1"),
        _share(c["11"], c["11"] + c["01"]).alias("precision"),
        _share(c["11"], c["11"] + c["10"]).alias("recall"),
    )


def confusion_matrix(df: DataFrame, normalize: bool = False) -> DataFrame:
    """Rows ``true_0, true_1``, columns ``pred_0, pred_1``; empty cells are 0."""
    rows = []
    for t in (0, 1):
        p0, p1 = F.col(f"c_{t}0"), F.col(f"c_{t}1")
        if normalize:
            p0, p1 = _share(p0, p0 + p1), _share(p1, F.col(f"c_{t}0") + p1)
        rows.append(
            F.struct(F.lit(f"true_{t}").alias("row"), p0.alias("pred_0"), p1.alias("pred_1"))
        )
    return _cells(df, ()).select(F.inline(F.array(*rows)))


def class_report(df: DataFrame, digits: int = 4) -> DataFrame:
    """Per-class and averaged precision, recall, F1 and support.

    Classes that occur on neither side are left out; the accuracy line carries only ``f1_score``.
    """
    lines = []
    for t in (0, 1):
        o = 1 - t
        hit, miss, false = F.col(f"c_{t}{t}"), F.col(f"c_{t}{o}"), F.col(f"c_{o}{t}")
        lines.append(
            F.struct(
                F.lit(str(t)).alias("name"),
                _share(hit, hit + false).alias("precision"),
                _share(hit, hit + miss).alias("recall"),
                _share(2 * hit, 2 * hit + miss + false).alias("f1_score"),
                (hit + miss).alias("support"),
                (hit + miss + false).alias("seen"),
            )
        )
    total = F.col("c_00") + F.col("c_01") + F.col("c_10") + F.col("c_11")
    accuracy = _share(F.col("c_00") + F.col("c_11"), total)
    base = _cells(df, ()).select(
        F.filter(F.array(*lines), lambda x: x["seen"] > 0).alias("lines"),
        total.alias("total"),
        accuracy.alias("accuracy"),
    )

    def average(weighted: bool, name: str) -> Column:
        weight = (lambda x: x["support"].cast("double")) if weighted else (lambda x: F.lit(1.0))

        def mean(metric: str) -> Column:
            parts = F.transform("lines", lambda x: x[metric] * weight(x))
            weights = F.transform("lines", weight)
            add = lambda a, v: a + v
            return _share(
                F.aggregate(parts, F.lit(0.0), add), F.aggregate(weights, F.lit(0.0), add)
            )

        return F.struct(
            F.lit(name).alias("name"),
            mean("precision").alias("precision"),
            mean("recall").alias("recall"),
            mean("f1_score").alias("f1_score"),
            F.col("total").alias("support"),
        )

    plain = F.transform(
        "lines",
        lambda x: F.struct(x["name"], x["precision"], x["recall"], x["f1_score"], x["support"]),
    )
    nothing = F.lit(None).cast("double")
    overall = F.struct(
        F.lit("accuracy").alias("name"),
        nothing.alias("precision"),
        nothing.alias("recall"),
        F.col("accuracy").alias("f1_score"),
        F.col("total").alias("support"),
    )
    table = base.select(
        F.inline(
            F.concat(
                plain,
                F.array(overall, average(False, "macro avg"), average(True, "weighted avg")),
            )
        )
    )
    return table.select(
        "name",
        *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1_score")],
        "support",
    )
