"""TF-IDF: fit on a corpus table, apply to any corpus table or stream.

Fitting shuffles terms only: a task counts a portion of its documents at once, so no (document, term)
pair crosses the network.  With a limit on the vocabulary, only terms that can still be among the
most frequent are counted by name (``candidate_statistics``).  Applying is row-local: term counting, idf weighting and the L2 norm are
Spark ML transformers over a broadcast vocabulary, with no shuffle and no window.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as S

from docsignal.functions import text as T
from docsignal.functions.lookup import constant
from docsignal.session import materialize

MAX_MODEL_TERMS = 200_000
TERM_PREFIX = "tfidf:"
SMALL_VOCABULARY = 50
COUNT_BUCKETS = 1 << 16
GUESS_SHARE = 16
PORTION_ITEMS = 1 << 21  # words or characters that a task counts at once


@dataclass(frozen=True)
class TfidfConfig:
    """``min_df``/``max_df``: an int counts documents, a float is a share of them."""

    max_terms: int | None = 200
    min_df: int | float = 2
    max_df: int | float = 1.0
    analyzer: str = "word"
    ngram_range: tuple[int, int] = (1, 1)
    lowercase: bool = True
    char_fallback: bool = True


@dataclass
class TfidfModel:
    """Fitted state: as large as the vocabulary, never as large as the corpus."""

    terms: list[str]
    df: list[int]
    tf_total: list[int]
    idf: list[float]
    n_docs: int
    config: TfidfConfig = field(default_factory=TfidfConfig)

    @property
    def feature_names(self) -> list[str]:
        return [TERM_PREFIX + term for term in self.terms]

    def vocabulary(self, spark: SparkSession) -> DataFrame:
        """The model as a table ``(term, idx, df, tf_total, idf)``."""
        rows = list(zip(self.terms, range(len(self.terms)), self.df, self.tf_total, self.idf))
        return spark.createDataFrame(
            rows, "term string, idx int, df bigint, tf_total bigint, idf double"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Persist as two small tables; an existing target is replaced."""
        self.vocabulary(spark).write.mode("overwrite").parquet(f"{path}/vocabulary")
        fitted = [(self.n_docs, json.dumps(asdict(self.config)))]
        spark.createDataFrame(fitted, "n_docs bigint, config string").write.mode("overwrite").parquet(
            f"{path}/corpus"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TfidfModel:
        rows = spark.read.parquet(f"{path}/vocabulary").orderBy("idx").collect()
        c = spark.read.parquet(f"{path}/corpus").first()
        config = json.loads(c.config)
        config = TfidfConfig(**config | {"ngram_range": tuple(config["ngram_range"])})
        return cls(
            [r.term for r in rows], [r.df for r in rows], [r.tf_total for r in rows],
            [r.idf for r in rows], c.n_docs, config,
        )


def _ngrams(items: Column, low: int, high: int, joiner: str) -> Column:
    """All runs of ``low..high`` neighbouring items of an array, joined."""

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(items) - n + 1, F.lit(1)))
        runs = F.transform(starts, lambda i: F.array_join(F.slice(items, i, n), joiner))
        return F.when(F.size(items) >= n, runs).otherwise(F.array().cast("array<string>"))

    sizes = [items if n == 1 else of_size(n) for n in range(low, high + 1)]
    return sizes[0] if len(sizes) == 1 else F.concat(*sizes)


def _with_items(df: DataFrame, config: TfidfConfig, text_col: str) -> DataFrame:
    """Append ``_items``, what terms are made of: the words in order, or the text whose characters count."""
    text = T.clean_text(F.col(text_col))
    staged = df.withColumn("_items", F.lower(text) if config.lowercase else text)
    if config.analyzer == "word":
        return staged.withColumn("_items", F.regexp_extract_all("_items", F.lit(T.TERM), F.lit(0)))
    if config.analyzer == "char":
        return staged.withColumn("_items", F.regexp_replace("_items", f"[{T.SPACE_CHARS}]{{2,}}", " "))
    raise ValueError(f"unknown analyzer {config.analyzer!r}")


def with_terms(
    df: DataFrame, config: TfidfConfig, text_col: str = "text", known: Sequence[str] = ()
) -> DataFrame:
    """Append ``_terms``, the document's terms (words, or characters if so configured) with repeats.

    Of character n-grams only the ``known`` ones; a text has several times as many as characters.
    """
    staged = _with_items(df, config, text_col)
    low, high = config.ngram_range
    if config.analyzer == "word":
        return staged.select(*df.columns, _ngrams(F.col("_items"), low, high, " ").alias("_terms"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(known, pa.string())
        for batch in batches:
            for lo, rows in _portions(batch.column(batch.num_columns - 1)):
                part = batch.slice(lo, len(rows.lengths))
                docs, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for gram in rows.grams(low, high):
                    place = pc.index_in(rows.spelled(gram), wanted).fill_null(-1).to_numpy()[gram.codes]
                    docs.append(rows.doc[gram.starts[place >= 0]])
                    terms.append(place[place >= 0])
                doc = np.concatenate(docs)
                found = wanted.take(pa.array(np.concatenate(terms)[np.argsort(doc, kind="stable")], pa.int64()))
                ends = np.cumsum(np.bincount(doc, minlength=part.num_rows))
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(offsets, found)], names=names
                )

    fields = [*df.schema.fields, S.StructField("_terms", S.ArrayType(S.StringType()))]
    names = [f.name for f in fields]
    return staged.select(*df.columns, "_items").mapInArrow(pick, S.StructType(fields))


@dataclass
class _Grams:
    """All runs of ``size`` items of some documents: equal runs have equal codes below ``kinds``."""

    size: int
    starts: np.ndarray
    codes: np.ndarray
    kinds: int


class _Portion:
    """The words or characters of some documents, one after the other."""

    def __init__(self, column: pa.Array):
        self.points = None
        if pa.types.is_list(column.type):
            self.items = column.flatten()
            self.lengths = np.diff(column.offsets.to_numpy())
        else:
            texts = [t.decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist()]
            self.points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
            self.items = pa.array(self.points)
            self.lengths = np.array([len(t) for t in texts], np.int64)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)

    def grams(self, low: int, high: int) -> Iterator[_Grams]:
        item, kinds = _dense(self.items)
        keys, span = item, kinds
        for n in range(1, high + 1):
            if n > 1:
                if span * kinds >= 1 << 62:
                    keys, span = _dense(pa.array(keys))
                keys = keys[: max(0, len(item) - n + 1)] * kinds + item[n - 1 :]
                span *= kinds
            if n >= low:
                starts = np.flatnonzero(self.doc[: len(keys)] == self.doc[n - 1 :])
                yield _Grams(n, starts, *_dense(pa.array(keys[starts])))

    def spelled(self, gram: _Grams) -> pa.Array:
        """The term of every code."""
        at = np.zeros(gram.kinds, np.int64)
        at[gram.codes] = gram.starts
        if self.points is None:
            words = [self.items.take(pa.array(at + i)) for i in range(gram.size)]
            return words[0] if gram.size == 1 else pc.binary_join_element_wise(*words, " ")
        points = self.points[at[:, None] + np.arange(gram.size)]
        widths = 1 + sum((points >= limit).astype(np.int32) for limit in (0x80, 0x800, 0x10000))
        offsets = np.concatenate([[0], np.cumsum(widths.sum(1))]).astype(np.int32)
        text = points.tobytes().decode("utf-32-le").encode()
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(text))

    def first_in_document(self, gram: _Grams) -> np.ndarray:
        """Whether a run is the one that stands for its equals in its document."""
        once = np.zeros(len(gram.codes), bool)
        bearer = np.zeros(gram.kinds, np.int64)
        ends = np.cumsum(np.bincount(self.doc[gram.starts], minlength=len(self.lengths)))
        for lo, hi in zip(np.concatenate([[0], ends]), ends):
            codes, own = gram.codes[lo:hi], np.arange(lo, hi)
            bearer[codes] = own
            once[lo:hi] = bearer[codes] == own
        return once


def _dense(values: pa.Array) -> tuple[np.ndarray, int]:
    """Equal values as equal numbers from 0, and how many there are."""
    found = values.dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), len(found.dictionary)


def _portions(column: pa.Array) -> Iterator[tuple[int, _Portion]]:
    """Neighbouring documents with few enough items together, and the number of the first."""
    lengths = (pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length)(column)
    before = np.cumsum(lengths.to_numpy(zero_copy_only=False)) // PORTION_ITEMS
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1), len(column)] if len(column) else [0]
    for lo, hi in zip(cuts, cuts[1:]):
        yield int(lo), _Portion(column.slice(int(lo), int(hi - lo)))


def _occurrences(df: DataFrame, config: TfidfConfig, text_col: str) -> DataFrame:
    """``(term, df, tf_total)``: the terms of every portion of documents with their counts there."""
    low, high = config.ngram_range

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows in _portions(batch.column(0)):
                for gram in rows.grams(low, high):
                    once = gram.codes[rows.first_in_document(gram)]
                    counts = [np.bincount(c, minlength=gram.kinds) for c in (once, gram.codes)]
                    yield pa.RecordBatch.from_arrays(
                        [rows.spelled(gram), *[pa.array(c, pa.int64()) for c in counts]],
                        names=["term", "df", "tf_total"],
                    )

    items = _with_items(df.select(text_col), config, text_col).select("_items")
    return items.mapInArrow(count, "term string, df bigint, tf_total bigint")


def term_statistics(
    df: DataFrame, config: TfidfConfig = TfidfConfig(), text_col: str = "text"
) -> DataFrame:
    """``(term, df, tf_total)`` over a corpus; the only shuffle is by term, after map-side combining."""
    return _counted(_occurrences(df, config, text_col), "term")


def _counted(rows: DataFrame, *by: str | Column) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("df").alias("df"), F.sum("tf_total").alias("tf_total"))


def candidate_statistics(
    df: DataFrame, n_docs: int, config: TfidfConfig, text_col: str = "text"
) -> DataFrame:
    """``term_statistics`` of every term that can be among the ``max_terms`` most frequent ones, and a few others.

    A sixteenth of the texts proposes terms.  One pass counts these by name and all others by hash
    bucket, so a task shuffles ``COUNT_BUCKETS`` lines at most, however many terms it met.  The count of
    the ``max_terms``-th proposed term that fits the document limits is a lower bound of what a term of
    the vocabulary must reach, and a bucket's count is an upper bound for each of its terms; a second
    pass, if any bucket reaches the bound, counts by name only the terms of these buckets.  What the sample proposes
    decides how many terms that are, never the result; a corpus whose bound is reached by every bucket
    is counted whole.
    """
    low, high = _bound(config.min_df, n_docs), _bound(config.max_df, n_docs)
    sample = df.where(F.pmod(F.xxhash64(text_col), F.lit(GUESS_SHARE)) == 0)
    seen = term_statistics(sample, config, text_col).orderBy(F.desc("tf_total"), "term")
    proposed = materialize(seen.limit(2 * config.max_terms).select("term", F.lit(True).alias("known")), "terms-proposed")
    all_terms = _occurrences(df, config, text_col)
    bucket = F.pmod(F.xxhash64("term"), F.lit(COUNT_BUCKETS))
    marked = all_terms.join(F.broadcast(proposed), "term", "left").select(
        F.when(F.col("known"), F.col("term")).alias("term"),
        F.when(F.col("known").isNull(), bucket).alias("bucket"),
        "df",
        "tf_total",
    )
    first_pass = materialize(_counted(marked, "term", "bucket"), "terms-bounds")
    known = first_pass.where("term IS NOT NULL").select("term", "df", "tf_total")
    best = known.where(F.col("df").between(low, high)).orderBy(F.desc("tf_total")).limit(config.max_terms)
    bound = best.agg(F.count("*").alias("n"), F.min("tf_total").alias("least")).first()
    least = bound.least if bound.n == config.max_terms else 0
    reach = first_pass.where(F.col("bucket").isNotNull() & (F.col("tf_total") >= least)).select("bucket")
    if reach.isEmpty():
        return known  # no term beside the proposed ones can be among the most frequent
    rest = (
        all_terms.withColumn("bucket", bucket)
        .join(F.broadcast(reach), "bucket", "left_semi")
        .join(F.broadcast(proposed), "term", "left_anti")
    )
    return known.unionByName(_counted(rest, "term"))


def _bound(limit: int | float, n_docs: int) -> float:
    return limit * n_docs if isinstance(limit, float) else limit


def select_vocabulary(stats: DataFrame, n_docs: int, config: TfidfConfig) -> DataFrame:
    """Prune by document frequency, keep the most frequent terms, index them alphabetically."""
    low, high = _bound(config.min_df, n_docs), _bound(config.max_df, n_docs)
    if high < low:
        raise ValueError("max_df corresponds to fewer documents than min_df")
    kept = stats.where(F.col("df").between(low, high))
    if config.max_terms is not None:
        kept = kept.orderBy(F.desc("tf_total"), "term").limit(config.max_terms)
    return kept.withColumn("idf", F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)


def fit_tfidf(
    df: DataFrame, config: TfidfConfig = TfidfConfig(), text_col: str = "text"
) -> TfidfModel:
    """Fit on all rows of ``df`` (pass the train rows only).

    A word vocabulary below ``max(50, half of max_terms)`` is replaced by character 3-5-grams.
    """
    if config.max_terms == 0:
        return TfidfModel([], [], [], [], 0, config)
    n_docs = df.count()
    if config.max_terms is None:
        stats = term_statistics(df, config, text_col)
    else:
        stats = candidate_statistics(df, n_docs, config, text_col)
    found = select_vocabulary(stats, n_docs, config)
    rows = found.limit(MAX_MODEL_TERMS + 1).collect()
    if len(rows) > MAX_MODEL_TERMS:
        raise ValueError(f"vocabulary exceeds {MAX_MODEL_TERMS} terms; set max_terms")
    if config.char_fallback and config.analyzer == "word":
        wanted = max(SMALL_VOCABULARY, (config.max_terms or 0) // 2)
        if len(rows) < wanted:
            chars = TfidfConfig(
                config.max_terms, config.min_df, config.max_df, "char", (3, 5),
                config.lowercase, char_fallback=False,
            )
            return fit_tfidf(df, chars, text_col)
    rows.sort(key=lambda r: r.term)
    return TfidfModel(
        [r.term for r in rows], [r.df for r in rows], [r.tf_total for r in rows],
        [r.idf for r in rows], n_docs, config,
    )


def with_tfidf_vector(
    df: DataFrame, model: TfidfModel, text_col: str = "text", output: str = "tfidf"
) -> DataFrame:
    """Append the L2-normalised sparse TF-IDF vector; documents without known terms stay zero."""
    counter = CountVectorizerModel.from_vocabulary(model.terms, "_terms", "_counts")
    weigher = ElementwiseProduct(
        scalingVec=Vectors.dense(model.idf), inputCol="_counts", outputCol="_weighted"
    )
    norm = Normalizer(p=2.0, inputCol="_weighted", outputCol=output)
    staged = with_terms(df, model.config, text_col, model.terms)
    return norm.transform(weigher.transform(counter.transform(staged))).select(
        *df.columns, output
    )


def with_tfidf_array(
    df: DataFrame, model: TfidfModel, text_col: str = "text", output: str = "tfidf"
) -> DataFrame:
    """Append the same weights as a dense ``array<double>`` in vocabulary order."""
    if not model.terms:
        return df.withColumn(output, F.array().cast(S.ArrayType(S.DoubleType())))
    return with_tfidf_vector(df, model, text_col, output).withColumn(
        output, vector_to_array(F.col(output))
    )


def tfidf_entries(weights: Column, terms: list[str]) -> Column:
    """Non-zero weights as an array of ``(term, value)`` in vocabulary order."""
    pairs = F.zip_with(constant(terms, "string"), weights, lambda t, v: F.struct(t.alias("term"), v.alias("value")))
    return F.filter(pairs, lambda p: p["value"] > 0)


def tfidf_rows(
    df: DataFrame, model: TfidfModel, key: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Long form ``(key, term, value)``; only the terms a document has are ever touched."""
    if not model.terms:
        return df.select(key, F.lit("").alias("term"), F.lit(0.0).alias("value")).limit(0)
    sparse = with_tfidf_vector(df.select(key, text_col), model, text_col).select(
        key, F.unwrap_udt("tfidf").alias("v")
    )
    terms = constant(model.terms, "string")
    entries = F.zip_with(
        "v.indices",
        "v.values",
        lambda i, x: F.struct(F.get(terms, i).alias("term"), x.alias("value")),
    )
    return sparse.select(key, F.inline(F.filter(entries, lambda e: e["value"] > 0)))
