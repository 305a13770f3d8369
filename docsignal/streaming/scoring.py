"""Scoring a text stream with fitted state.

Signals, TF-IDF weights, prompts and predictions are row-local, so the batch operators are applied
to the streaming frame as they are: no state, no watermark, no late data to handle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as S

from docsignal.operators.frame import FeatureModel
from docsignal.operators.models import FittedModel
from docsignal.operators.prompts import inference_prompts

TEXT_SCHEMA = S.StructType(
    [S.StructField("doc_id", S.LongType()), S.StructField("text", S.StringType())]
)


def read_text_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: S.StructType = TEXT_SCHEMA
) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def score_stream(stream: DataFrame, features: FeatureModel) -> DataFrame:
    """``(doc_id, ..., features)`` for every arriving text."""
    return features.transform(stream)


def prompt_stream(stream: DataFrame, features: FeatureModel, **options) -> DataFrame:
    """``(doc_id, prompt)`` for every arriving text."""
    return inference_prompts(score_stream(stream, features), features.names, **options)


def predict_stream(stream: DataFrame, features: FeatureModel, model: FittedModel) -> DataFrame:
    """``(doc_id, y_true, y_pred)``; the stream must carry ``label`` (NULL where unknown)."""
    return model.predict(score_stream(stream, features))
