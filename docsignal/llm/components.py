"""Connected components of an edge table, by contraction on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docsignal.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    In each round a node joins its neighbour of least hash if that is less than its own, edges move
    to the joined nodes, and loops and repeats go.  With hashed priorities the number of edges falls
    by a constant factor a round whatever the shape (chains too); a star takes two.  Every round's
    joins and edges are written, so lineage stays short; at the end nodes follow the joins in turn.
    """
    edges = materialize(_clean(edges.select("a", "b")), "cc-edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.withColumn("label", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("id"))).alias("m")
        joins = (
            both.groupBy("a")
            .agg(least)
            .where((F.col("m.h") < F.xxhash64("a")) | ((F.col("m.h") == F.xxhash64("a")) & (F.col("m.id") < F.col("a"))))
            .select(F.col("a").alias("old"), F.col("m.id").alias("new"))
        )
        joins = materialize(joins, "cc-joins")
        labels = _renamed(labels, joins, "label")
        edges = materialize(_clean(_renamed(_renamed(edges, joins, "a"), joins, "b")), "cc-edges")
    least = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(least, "label").select("node", "component")


def _clean(edges: DataFrame) -> DataFrame:
    return (
        edges.where("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _renamed(rows: DataFrame, joins: DataFrame, column: str) -> DataFrame:
    new = F.coalesce("new", column).alias(column)
    others = [c for c in rows.columns if c != column]
    out = rows.join(joins, rows[column] == F.col("old"), "left").select(*others, new)
    return out.select(*rows.columns)
