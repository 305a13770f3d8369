"""Engineered signal block: stateless DataFrame -> DataFrame steps (batch or stream)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from docsignal.functions import text as T
from docsignal.functions.sentiment import with_sentiment


def with_style(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Append the 19 style signals."""
    return _append(df, text_col, style=True, readability=False)


def with_readability(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Append sentence, syllable and complex-word counts and the three readability scores."""
    return _append(df, text_col, style=False, readability=True)


def _append(df: DataFrame, text_col: str, style: bool, readability: bool) -> DataFrame:
    # Words and their counts get a stage of their own so that Catalyst computes each of them once per row.
    staged = (
        df.withColumn("_t", T.clean_text(F.col(text_col)))
        .withColumn("_w", T.words(F.col("_t")))
        .withColumn("_c", T.word_counts(F.col("_w")))
    )
    out = [F.col(c) for c in df.columns]
    if style:
        staged = staged.withColumn("_x", T.beyond_ascii(F.col("_t"))).withColumn("_a", T.char_counts(F.col("_t")))
        columns = T.style_columns(*(F.col(c) for c in ("_t", "_w", "_c", "_a", "_x")))
        out += [c.alias(name) for name, c in columns.items()]
    if not readability:
        return staged.select(*out)
    staged = staged.withColumns(
        {
            "sentence_count": T.sentence_count(F.col("_t")),
            **T.syllable_columns(F.col("_c")),
        }
    )
    scores = T.readability_columns(
        F.size("_w").cast("double"),
        F.col("sentence_count"),
        F.col("syllable_count"),
        F.col("complex_word_count"),
    )
    counts = ["sentence_count", "syllable_count", "complex_word_count"]
    return staged.select(*out, *counts, *[c.alias(name) for name, c in scores.items()])


def engineered_block(
    df: DataFrame, text_col: str = "text", lexicon: Mapping[str, float] | None = None
) -> DataFrame:
    """Append the 20 engineered columns in declared order, keeping the input columns."""
    keep = df.columns
    scored = with_sentiment(_append(df, text_col, True, True), text_col, lexicon)
    return scored.select(*keep, *T.ENGINEERED_NAMES)
