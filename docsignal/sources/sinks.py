"""Writing results; an existing target is replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docsignal.operators.outliers import removed_rows


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per row: metrics, names, parameters."""
    df.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_removed(scored: DataFrame, path: str, key: str = "doc_id") -> None:
    """Keys of the removed rows (their number is the row count)."""
    write_table(removed_rows(scored, key), path)


def normalize_newlines(df: DataFrame, column: str = "prompt") -> DataFrame:
    return df.withColumn(column, F.regexp_replace(column, "\r\n?", "\n"))


def write_prompts(df: DataFrame, path: str) -> None:
    """Prompts hold line breaks, so they are written as JSON records, with LF line ends."""
    write_json(normalize_newlines(df), path)
