"""Reading corpora: declared schemas, column checks, standard names, keys, optional artefacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as S

from docsignal.session import materialize

# The junk index column and the names of a raw corpus file.
INDEX_COLUMN = "Unnamed: 0"
RAW_TEXT, RAW_LABEL = "news", "label"

RAW_SCHEMA = S.StructType(
    [
        S.StructField(INDEX_COLUMN, S.LongType()),
        S.StructField(RAW_TEXT, S.StringType()),
        S.StructField(RAW_LABEL, S.IntegerType()),
    ]
)


def read_table(
    spark: SparkSession, directory: str, name: str, partitions: int | None = None, key: str = "doc_id"
) -> DataFrame:
    """A Parquet table; ``partitions`` deals its rows out by key, for files with few row groups.

    A scan has one task a row group at most, so a table in one of them keeps a single core busy.
    """
    df = spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
    return df.repartition(partitions, key) if partitions else df


def read_csv(spark: SparkSession, path: str, schema: S.StructType | str) -> DataFrame:
    """CSV with a header and quoted multi-line fields, columns checked against the schema."""
    if isinstance(schema, str):
        schema = S.StructType.fromDDL(schema)
    found = spark.read.options(header=True, multiLine=True, escape='"').csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in found]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}; found {found}")
    by_name = S.StructType([S.StructField(c, S.StringType()) for c in found])
    raw = spark.read.schema(by_name).options(header=True, multiLine=True, escape='"').csv(path)
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def import_csv(
    spark: SparkSession, path: str, schema: S.StructType | str, partitions: int | None = None
) -> DataFrame:
    """``read_csv``, written once as Parquet in ``partitions`` parts and read from there.

    Quoted line breaks allow one task a CSV file only.  That task runs once, here, and all that
    follows is spread over the parts.
    """
    rows = read_csv(spark, path, schema)
    return materialize(rows.repartition(partitions) if partitions else rows, "imported")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail before any job runs when a column is missing, naming what was found."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def standardize(
    df: DataFrame,
    text_col: str = RAW_TEXT,
    label_col: str = RAW_LABEL,
    drop_cols: Sequence[str] = (INDEX_COLUMN,),
    key_col: str | None = None,
) -> DataFrame:
    """``(doc_id, text, label)`` under standard names; junk columns go.

    The key is ``key_col``, else the index column if present, else a number fixed by writing the
    numbered rows once (numbers are given per partition, so copies of a text cause no skew).
    """
    require_columns(df, [text_col, label_col])
    if key_col is None and INDEX_COLUMN in df.columns:
        key_col = INDEX_COLUMN
    if key_col is None:
        df = materialize(df.withColumn("doc_id", F.monotonically_increasing_id()), "keyed")
    else:
        df = df.withColumn("doc_id", F.col(f"`{key_col}`"))
    drop = [c for c in drop_cols if c in df.columns and c not in ("doc_id", text_col, label_col)]
    return df.drop(*drop).select(
        "doc_id", F.col(text_col).alias("text"), F.col(label_col).alias("label")
    )


def with_labels(df: DataFrame, labels: DataFrame, label: str, key: str = "doc_id") -> DataFrame:
    """Attach a label by key (rows without one are left out)."""
    return df.join(labels.select(key, F.col(label).alias("label")), key)


def read_or_empty(
    spark: SparkSession, path: str, schema: S.StructType | str, fmt: str = "parquet"
) -> DataFrame:
    """An optional artefact: an absent path gives an empty frame of the declared schema."""
    try:
        reader = spark.read.schema(schema)
        return (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND",):
            raise
        return spark.createDataFrame([], schema)
