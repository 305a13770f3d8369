"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. language: documents whose language is undetermined (no letters, or nothing learned) go; mixtures
   stay, however small the share of their first language.
2. exact: of equal texts the largest doc_id stays.
3. near: of each group of near copies the smallest doc_id stays.
4. passages: bytes of passages that a document with a smaller doc_id also has are cut out.
5. packing: the remaining texts as pieces of packed token sequences.

Stages 1 to 4 return the columns of ``documents``.  Rows are told apart by doc_id; a doc_id that
comes more than once is judged by each stage as its operator says, and rows are only matched with
decisions about the same doc_id.  An empty table passes through; NULL texts go in stage 1.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from docsignal.llm import exact, jaccard, langid, packing, suffixes
from docsignal.llm.common import read
from docsignal.session import checkpoint_root

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SHARE = 0.0  # a clean document in many languages has a small share of each


def _kept(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose key is in ``ids`` (once each), NULL keys included."""
    return docs.join(ids, docs.doc_id.eqNullSafe(ids.doc_id), "left_semi").select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identify languages by what the held-in documents of this stage teach; undetermined ones go."""
    model = langid.learn(docs.where(~langid.held_out()))
    verdicts = langid.predict(docs.select(*COLUMNS), model, carry=COLUMNS[1:])
    return verdicts.where(F.col("lang_pred") != langid.UNDETERMINED).select(*COLUMNS)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stateful streaming deduplication; one row of each group of equal texts stays."""
    return exact.unique_rows(docs, COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join; the smallest doc_id of each component stays."""
    found = jaccard.similarity_components(docs)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return _kept(docs, found.where(first).select("doc_id").distinct())


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of the texts; characters cut apart go with them."""
    cut = suffixes.remove_repeats(docs, as_text=True, carry=["lang", "source"])
    size = F.length("kept").cast("long").alias("n_chars")
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", size)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, as ``op8_packing`` returns them."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact", exact_copies),
    ("near", near_copies),
    ("passages", passages),
    ("packing", packed),
]

#: Learning, suffix removal and tokens can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result lies in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    place = f"{checkpoint_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = f"{place}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
