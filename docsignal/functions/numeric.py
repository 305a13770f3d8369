"""Coercion, recoding and number formatting as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as S


def to_number(column: Column) -> Column:
    """Double value; unparsable, NULL and NaN become 0.0."""
    number = column.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(number)


def to_label(column: Column) -> Column:
    """Strict integer label: a value that is not a number fails the job (ANSI cast)."""
    number = column.cast("double")
    return F.when(
        number.isNull() | F.isnan(number), F.raise_error(F.lit("label is missing")).cast("int")
    ).otherwise(number.cast("int"))


def coerce_features(df: DataFrame, label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """Coerce every feature column in one projection and cast the label strictly."""
    return df.select(
        *keys,
        *[to_number(F.col(c)).alias(c) for c in df.columns if c != label and c not in keys],
        to_label(F.col(label)).alias(label),
    )


def recode(column: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep the others."""
    out = F.when(F.lit(False), column)
    for old, new in mapping.items():
        out = out.when(column == old, F.lit(new))
    return out.otherwise(column)


def round_numbers(df: DataFrame, decimals: int) -> DataFrame:
    """Round every floating-point column for display."""
    floating = (S.DoubleType, S.FloatType)
    return df.select(
        *[
            F.round(f.name, decimals).alias(f.name) if isinstance(f.dataType, floating) else f.name
            for f in df.schema.fields
        ]
    )


def rounded_text(value: Column, decimals: int) -> Column:
    """The text of a float rounded to ``decimals``: ``12.0``, ``0.25``, ``-0.0``.

    ``format_number`` rounds the exact binary value half to even, which ``round`` does not.
    """
    fixed = F.replace(F.format_number(value, decimals), F.lit(","), F.lit(""))
    if decimals == 0:
        return F.concat(fixed, F.lit(".0"))
    bare = F.rtrim(fixed, F.lit("0"))
    return F.when(bare.endswith("."), F.concat(bare, F.lit("0"))).otherwise(bare)
