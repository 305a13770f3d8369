"""Feature rows verbalised as instruction prompts, and labels read back from generated text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from docsignal.functions import text as T
from docsignal.functions.lookup import constant
from docsignal.functions.numeric import rounded_text
from docsignal.operators.metrics import binary_metrics, class_report
from docsignal.operators.tfidf import TERM_PREFIX, tfidf_entries

# Fixed value: the instruction that opens every prompt.
INSTRUCTION = (
    "You are a misinformation classifier. Use the signals to output a single digit: "
    "0 for fake/misleading, 1 for real/credible. Reply with just the digit."
)


def term_of(name: str, prefix: str = TERM_PREFIX) -> str:
    """What follows the first colon of a prefixed feature name."""
    return name.split(":", 1)[-1]


def top_terms(weights: Column, terms: Sequence[str], k: int) -> Column:
    """The ``k`` heaviest non-zero terms, heaviest first, ties in column order."""
    entries = F.transform(
        tfidf_entries(weights, list(terms)),
        lambda e, i: F.struct(
            (-e["value"]).alias("rank"), i.alias("i"), e["term"].alias("term"), e["value"].alias("value")
        ),
    )
    return F.slice(F.sort_array(entries), 1, max(0, k))


def signals_text(
    features: Column,
    names: Sequence[str],
    top_k: int = 20,
    decimals: int = 3,
    include_engineered: bool = True,
    prefix: str = TERM_PREFIX,
) -> Column:
    """``Engineered: ...`` and ``Top-TFIDF: ...`` lines, or ``No signals.``"""
    lines = []
    engineered = [(i, n) for i, n in enumerate(names) if n in T.ENGINEERED_NAMES]
    if include_engineered and engineered:
        pairs = [
            F.concat(F.lit(f"{n}="), rounded_text(F.get(features, F.lit(i)), decimals))
            for i, n in engineered
        ]
        lines.append(F.concat(F.lit("Engineered: "), F.concat_ws(", ", *pairs)))
    terms = [(i, n) for i, n in enumerate(names) if n.startswith(prefix)]
    if terms:
        at = constant([i for i, _ in terms], "int")
        weights = F.transform(at, lambda i: F.get(features, i))
        best = top_terms(weights, [term_of(n, prefix) for _, n in terms], top_k)
        spoken = F.array_join(
            F.transform(
                best, lambda e: F.concat(e["term"], F.lit(":"), rounded_text(e["value"], decimals))
            ),
            ", ",
        )
        lines.append(F.when(spoken != "", F.concat(F.lit("Top-TFIDF: "), spoken)))
    if not lines:
        return F.lit("No signals.")
    return F.coalesce(F.nullif(F.concat_ws("\n", *lines), F.lit("")), F.lit("No signals."))


def _body(signals: Column) -> Column:
    return F.concat(F.lit(f"{INSTRUCTION}\n\nSIGNALS:\n"), signals, F.lit("\n\nAnswer:"))


def training_prompts(
    df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("doc_id",), **options
) -> DataFrame:
    """``(keys..., prompt, label)`` with the label after ``Answer:``."""
    label = F.col("label").cast("int")
    body = _body(signals_text(F.col("features"), names, **options))
    prompt = F.concat(body, F.lit(" "), label.cast("string"))
    return df.select(*keys, prompt.alias("prompt"), label.alias("label"))


def inference_prompts(
    df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("doc_id",), **options
) -> DataFrame:
    """``(keys..., prompt)`` ending in ``Answer:``."""
    body = _body(signals_text(F.col("features"), names, **options))
    return df.select(*keys, body.alias("prompt"))


def prompt_corpus(
    df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("doc_id",), **options
) -> DataFrame:
    """All splits at once: train and val rows get the label, test rows end in ``Answer:``."""
    body = _body(signals_text(F.col("features"), names, **options))
    answer = F.concat(F.lit(" "), F.col("label").cast("int").cast("string"))
    shown = F.when(F.col("split") == "test", F.lit("")).otherwise(answer)
    return df.select(*keys, "split", F.concat(body, shown).alias("prompt"), "label")


def generated_label(text: Column) -> Column:
    """The first ``0`` or ``1`` in a generated text; NULL when there is none."""
    return F.nullif(F.regexp_extract(text, "[01]", 0), F.lit("")).cast("int")


def judge_generations(df: DataFrame, text_col: str = "generated") -> DataFrame:
    """Metrics over all rows of ``(generated, y_true)``; an unreadable answer counts as wrong."""
    counts = {"n_rows": F.count(F.lit(1)), "n_unreadable": F.count_if(F.col("unreadable"))}
    return binary_metrics(_answers(df, text_col), also=counts)


def generation_report(df: DataFrame, text_col: str = "generated") -> DataFrame:
    """Per-class report over all rows; an unreadable answer counts as the other class."""
    return class_report(_answers(df, text_col))


def _answers(df: DataFrame, text_col: str) -> DataFrame:
    said = generated_label(F.col(text_col))
    wrong = 1 - F.col("y_true")
    return df.select(
        "y_true", F.coalesce(said, wrong).alias("y_pred"), said.isNull().alias("unreadable")
    )
