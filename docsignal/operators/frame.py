"""Feature frames: key, label, split and one dense feature array, plus long and wide views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docsignal.functions import text as T
from docsignal.functions.lookup import constant
from docsignal.functions.sentiment import DEMO_LEXICON, read_lexicon
from docsignal.operators.signals import engineered_block
from docsignal.operators.tfidf import TfidfConfig, TfidfModel, fit_tfidf, with_tfidf_array


@dataclass
class FeatureModel:
    """What a fitted featurizer needs at scoring time."""

    tfidf: TfidfModel
    lexicon: Mapping[str, float] | None = None

    @property
    def names(self) -> list[str]:
        return T.ENGINEERED_NAMES + self.tfidf.feature_names

    def save(self, spark: SparkSession, path: str) -> None:
        """Vocabulary, corpus settings and lexicon as small tables; replaces the target."""
        self.tfidf.save(spark, f"{path}/tfidf")
        lexicon = DEMO_LEXICON if self.lexicon is None else self.lexicon
        spark.createDataFrame(list(lexicon.items()), "token string, valence double").write.mode(
            "overwrite"
        ).parquet(f"{path}/lexicon")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        lexicon = read_lexicon(spark.read.parquet(f"{path}/lexicon"))
        return cls(TfidfModel.load(spark, f"{path}/tfidf"), lexicon)

    def transform(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """Replace the text by ``features``; row-local, so it also runs on a stream."""
        keep = [c for c in df.columns if c != text_col]
        block = engineered_block(
            with_tfidf_array(df, self.tfidf, text_col, "_tfidf"), text_col, self.lexicon
        )
        engineered = F.array(*[F.col(c) for c in T.ENGINEERED_NAMES])
        return block.select(*keep, F.concat(engineered, F.col("_tfidf")).alias("features"))


def fit_features(
    train: DataFrame,
    config: TfidfConfig = TfidfConfig(),
    lexicon: Mapping[str, float] | None = None,
    text_col: str = "text",
) -> FeatureModel:
    """Fit on train rows only; apply to every split."""
    return FeatureModel(fit_tfidf(train, config, text_col), lexicon)


def names_array(names: Sequence[str]) -> Column:
    return constant(names, "string")


def long_features(
    df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("doc_id", "label")
) -> DataFrame:
    """Canonical long form ``(keys..., feature, value)`` of the non-zero features."""
    pairs = F.zip_with(
        names_array(names),
        F.col("features"),
        lambda n, v: F.struct(n.alias("feature"), v.alias("value")),
    )
    return df.select(*keys, F.inline(F.filter(pairs, lambda p: p["value"] != 0)))


def wide_features(df: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One column per feature, on request only."""
    return df.select(
        *keys, *[F.get("features", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )


def mask_array(features: Column, mask: Sequence[bool]) -> Column:
    """Keep the array positions whose mask bit is on, in order."""
    on = constant([i for i, bit in enumerate(mask) if bit], "int")
    return F.transform(on, lambda i: F.get(features, i))


def mask_columns(
    df: DataFrame, mask: Sequence[bool], label: str = "label", keys: Sequence[str] = ()
) -> DataFrame:
    """Keep keys, the columns whose mask bit is on, and the label."""
    features = [c for c in df.columns if c != label and c not in keys]
    return df.select(*keys, *[c for c, bit in zip(features, mask, strict=True) if bit], label)


def drop_engineered(
    df: DataFrame, label: str = "label", keys: Sequence[str] = ()
) -> DataFrame:
    """Ablation: keep every feature column outside the engineered block."""
    drop = [c for c in df.columns if c in T.ENGINEERED_NAMES and c != label and c not in keys]
    return df.drop(*drop)


def align_columns(df: DataFrame, reference: Sequence[str]) -> DataFrame:
    """Restore a reference column list: a missing column fails, extra ones go."""
    missing = [c for c in reference if c not in df.columns]
    if missing:
        raise ValueError(f"cannot align: the frame lacks {', '.join(missing)}")
    return df.select(*reference)


def keep_features(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long-form alignment or mask: keep the rows of the listed features."""
    return long.where(F.col("feature").isin(list(names)))
