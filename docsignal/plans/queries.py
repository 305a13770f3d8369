"""One registered query per operator: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docsignal.functions import text as T
from docsignal.functions.lookup import constant
from docsignal.functions.numeric import coerce_features, recode
from docsignal.functions.sentiment import DEMO_LEXICON, read_lexicon, with_sentiment
from docsignal.operators import boosting, folds, frame, metrics, models, outliers, prompts, reports, svm, tuning
from docsignal.operators.knn import knn_distances, knn_score
from docsignal.operators.matrix import (
    Scaler, as_double_array, covariance, fit_scaler, gram_sums, ledoit_wolf, scale,
)
from docsignal.operators.selection import Breeding, Scoring, search_subset
from docsignal.operators.signals import engineered_block, with_readability, with_style
from docsignal.operators.tfidf import (
    TfidfConfig, fit_tfidf, term_statistics, tfidf_rows, with_tfidf_array,
)
from docsignal.plans import workflow
from docsignal.session import materialize
from docsignal.sources.sinks import normalize_newlines
from docsignal.sources.tables import INDEX_COLUMN, read_table, standardize, with_labels

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BIGRAMS = TfidfConfig(max_terms=150, min_df=0.01, max_df=0.9, ngram_range=(1, 2))
CHARS = TfidfConfig(max_terms=100, analyzer="char", ngram_range=(3, 5))
RARE_WORDS = TfidfConfig(max_terms=120, min_df=0.5)
PAIR = ["avg_word_len", "unique_word_ratio"]
CELL_ROWS = 128  # low, so that small tables too are searched in several cells
PAIR_OUTLIERS = outliers.OutlierConfig(e_md=1.5, e_knn=1.0, k=10)
TRIALS = [
    tuning.Trial(1.5, 1.0, 5),
    tuning.Trial(2.0, 1.5, 10, "union"),
    tuning.Trial(2.5, 2.0, 20, "union", "kth_distance"),
    tuning.Trial(1.8, 1.2, 30, "intersection", "kth_distance"),
    tuning.Trial(3.0, 2.5, 15, "union"),
    tuning.Trial(1.6, 3.0, 25, "intersection"),
]
LENGTH_LIMITS = [200, 400, 800, 1600, 3200]
SVM_COSTS = [0.25, 1.0, 4.0]
FOREST = {"n_estimators": 20, "max_depth": 10, "min_samples_leaf": 1}
BOOSTED = {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.2, "subsample": 1.0}
STUDY_ROWS = list(zip(sorted(reports.SHORT_NAMES)[:5], LENGTH_LIMITS))
PRIORITIES = {"1-URGENT": "URG", "2-HIGH": "HI", "5-LOW": "LO"}
TFIDF = TfidfConfig()


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


#: Session setting: into how many parts texts are dealt after the scan (unset: as the files give them).
TEXT_PARTITIONS = "spark.docsignal.text.partitions"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    parts = spark.conf.get(TEXT_PARTITIONS, None)
    return read_table(spark, sf, "documents", int(parts) if parts else None).select("doc_id", "text")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return with_labels(documents(spark, sf), read_table(spark, sf, "labels"), "quality")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label"
    )


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))


# --- sources, projections, casts ------------------------------------------------------------


@register
def standardize_corpus(spark: SparkSession, sf: str) -> DataFrame:
    raw = documents(spark, sf).join(read_table(spark, sf, "labels"), "doc_id")
    named = raw.withColumnsRenamed({"doc_id": INDEX_COLUMN, "text": "news", "quality": "label"})
    return standardize(named)


@register
def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select(
        "event_id",
        "value",
        "props",
        F.regexp_extract("props", "[0-9]+", 0).alias("prop_number"),
        F.col("user_id").cast("string").alias("label"),
    )
    return coerce_features(events, keys=["event_id"])


@register
def align_columns(spark: SparkSession, sf: str) -> DataFrame:
    wide = with_style(labelled(spark, sf))
    return frame.align_columns(wide, ["doc_id", "word_count", "char_len", "label"])


@register
def drop_engineered(spark: SparkSession, sf: str) -> DataFrame:
    wide = with_style(labelled(spark, sf)).drop("text")
    return rounded(
        frame.drop_engineered(wide, keys=["doc_id"]), "avg_sentence_length_words"
    )


@register
def mask_project(spark: SparkSession, sf: str) -> DataFrame:
    mask = [i % 3 == 0 for i in range(64)]
    kept = embeddings(spark, sf).select(
        "vec_id", "label", F.posexplode(frame.mask_array(F.col("features"), mask))
    )
    return rounded(kept.withColumnsRenamed({"pos": "idx", "col": "value"}), "value")


@register
def mask_columns(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.col("l_returnflag").alias("label"),
    )
    return frame.mask_columns(
        lines, [True, False, True, False], keys=["l_orderkey", "l_linenumber"]
    )


@register
def recode_values(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    return orders.select("o_orderkey", recode(F.col("o_orderpriority"), PRIORITIES).alias("priority"))


@register
def round_report(spark: SparkSession, sf: str) -> DataFrame:
    customers = read_table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 7).alias("balance"), "c_name"
    )
    return reports.report_head(customers.drop("c_name"), [F.desc("balance"), "c_custkey"])


# --- text signals ---------------------------------------------------------------------------


@register
def style_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        with_style(documents(spark, sf)).drop("text"), *T.STYLE_NAMES, *T.STYLE_EXTRA_NAMES
    )


@register
def readability(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(with_readability(documents(spark, sf)).drop("text"), *T.READABILITY_NAMES)


def three_letter_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """The demonstration lexicon plus three-letter words of ``benchmark`` (at most 26 ** 3)."""
    found = (
        read_table(spark, sf, "benchmark")
        .select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))))
        .where(F.length("col") == 3)
        .distinct()
        .where(~F.col("col").isin(list(DEMO_LEXICON)))
    )
    spread = F.pmod(F.ascii("col") + 3 * F.ascii(F.substring("col", 2, 1)), F.lit(9)) - 4
    derived = found.select(F.col("col").alias("token"), (spread * 0.7).alias("valence"))
    demo = spark.createDataFrame(list(DEMO_LEXICON.items()), "token string, valence double")
    return demo.unionByName(derived.where("valence != 0"))


@register
def lexicon_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    lexicon = read_lexicon(three_letter_lexicon(spark, sf))
    return with_sentiment(documents(spark, sf), lexicon=lexicon).drop("text")


@register
def engineered_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(engineered_block(documents(spark, sf)).drop("text"), *T.ENGINEERED_NAMES)


# --- TF-IDF and feature frames ----------------------------------------------------------------


@register
def term_counts(spark: SparkSession, sf: str) -> DataFrame:
    return term_statistics(documents(spark, sf))


def _vocabulary(spark: SparkSession, df: DataFrame, config: TfidfConfig) -> DataFrame:
    return rounded(fit_tfidf(df, config).vocabulary(spark), "idf")


@register
def tfidf_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return _vocabulary(spark, documents(spark, sf), TfidfConfig())


@register
def tfidf_fallback_vocab(spark: SparkSession, sf: str) -> DataFrame:
    """Too few frequent words, so the fit falls back to character n-grams."""
    return _vocabulary(spark, read_table(spark, sf, "benchmark"), RARE_WORDS)


def _weights(spark: SparkSession, sf: str, config: TfidfConfig) -> DataFrame:
    texts = documents(spark, sf)
    return rounded(tfidf_rows(texts, fit_tfidf(texts, config)), "value")


@register
def tfidf_word_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _weights(spark, sf, TfidfConfig())


@register
def tfidf_bigram_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _weights(spark, sf, BIGRAMS)


@register
def tfidf_char_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _weights(spark, sf, CHARS)


@register
def top_terms_per_doc(spark: SparkSession, sf: str) -> DataFrame:
    texts = documents(spark, sf)
    model = fit_tfidf(texts)
    best = prompts.top_terms(F.col("tfidf"), model.terms, 5)
    ranked = with_tfidf_array(texts, model).select("doc_id", F.posexplode(best))
    return ranked.select(
        "doc_id",
        (F.col("pos") + 1).alias("rank"),
        "col.term",
        F.round("col.value", 6).alias("value"),
    )


def prepared_corpus(spark: SparkSession, sf: str, test_size: float = 0.0) -> workflow.Prepared:
    """Labelled documents, split, features fitted on the train rows."""
    corpus = workflow.assign_splits(labelled(spark, sf), test_size=test_size)
    return workflow.prepare(corpus, TFIDF)


@register
def feature_long(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepared_corpus(spark, sf)
    rows = frame.long_features(prepared.frame, prepared.names, ["doc_id", "label", "split"])
    return rounded(rows, "value")


@register
def feature_wide(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepared_corpus(spark, sf)
    names = T.ENGINEERED_NAMES + [f"term_{i}" for i in range(TFIDF.max_terms)]
    wide = frame.wide_features(prepared.frame, names, ["doc_id", "label", "split"])
    return rounded(wide, *names)


# --- matrices and outliers ----------------------------------------------------------------------


@register
def column_moments(spark: SparkSession, sf: str) -> DataFrame:
    scaler = fit_scaler(embeddings(spark, sf))
    pairs = F.arrays_zip(constant(scaler.mean).alias("mean"), constant(scaler.std).alias("std"))
    one = spark.range(1).select(F.posexplode(pairs).alias("idx", "m"))
    return rounded(one.select("idx", "m.mean", "m.std"), "mean", "std")


@register
def scale_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = embeddings(spark, sf)
    scaled = scale(rows, fit_scaler(rows))
    return rounded(
        scaled.select("vec_id", F.posexplode("features").alias("idx", "value")), "value"
    )


def _matrix_table(spark: SparkSession, matrix) -> DataFrame:
    d = len(matrix)
    flat = constant(matrix.ravel())
    one = spark.range(1).select(F.posexplode(flat).alias("at", "value"))
    return rounded(
        one.select(
            F.floor(F.col("at") / d).cast("int").alias("i"), F.pmod("at", F.lit(d)).alias("j"), "value"
        ),
        "value",
    )


def _embedding_sums(spark: SparkSession, sf: str):
    rows = embeddings(spark, sf)
    fitted = fit_scaler(rows)
    return gram_sums(rows, {None: Scaler(fitted.mean, fitted.std * 0 + 1, fitted.n)})[None]


@register
def covariance_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _matrix_table(spark, covariance(_embedding_sums(spark, sf), use_ledoit=False))


@register
def ledoit_wolf_covariance(spark: SparkSession, sf: str) -> DataFrame:
    return _matrix_table(spark, ledoit_wolf(_embedding_sums(spark, sf))[0])


def _near(spark: SparkSession, sf: str, k: int, mode: str, p: float = 2.0) -> DataFrame:
    near = knn_distances(embeddings(spark, sf), k, "vec_id", p=p, chunk_rows=CELL_ROWS)
    score = knn_score(F.col("distances"), k, mode).alias("knn_score")
    return near.select("vec_id", score)


@register
def knn_avg(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_near(spark, sf, 10, "avg_k_distance"), "knn_score")


@register
def knn_kth(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_near(spark, sf, 5, "kth_distance"), "knn_score")


@register
def knn_manhattan(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_near(spark, sf, 3, "avg_k_distance", 1.0), "knn_score")


@register
def sigma_flags(spark: SparkSession, sf: str) -> DataFrame:
    scores = materialize(_near(spark, sf, 10, "avg_k_distance"), "flag-scores")
    return rounded(outliers.sigma_flag(scores, "knn_score", 1.5, "knn_outlier"), "knn_score")


def two_signals(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as points of two signals."""
    signals = with_style(documents(spark, sf))
    return signals.select("doc_id", F.array(*PAIR).alias("features"))


@register
def mahalanobis_ledoit(spark: SparkSession, sf: str) -> DataFrame:
    points = materialize(two_signals(spark, sf), "pairs")
    return rounded(outliers.mahalanobis_scores(points).drop("features"), "md_score")


@register
def mahalanobis_empirical(spark: SparkSession, sf: str) -> DataFrame:
    points = materialize(two_signals(spark, sf), "pairs")
    scored = outliers.mahalanobis_scores(points, use_ledoit=False)
    return rounded(scored.drop("features"), "md_score")


def _pair_scores(spark: SparkSession, sf: str, combine: str = "intersection") -> DataFrame:
    config = outliers.OutlierConfig(**{**vars(PAIR_OUTLIERS), "combine": combine})
    return outliers.score_outliers(two_signals(spark, sf), config, chunk_rows=CELL_ROWS)


@register
def outlier_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_pair_scores(spark, sf), "md_score", "knn_score")


@register
def outlier_union(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_pair_scores(spark, sf, "union"), "md_score", "knn_score")


@register
def outlier_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    kept = outliers.keep_inliers(_pair_scores(spark, sf, "union"))
    return rounded(kept.select("doc_id", "md_score", "knn_score"), "md_score", "knn_score")


@register
def outlier_removed(spark: SparkSession, sf: str) -> DataFrame:
    return outliers.removed_rows(_pair_scores(spark, sf, "union"))


@register
def outlier_counts(spark: SparkSession, sf: str) -> DataFrame:
    return outliers.removal_counts(_pair_scores(spark, sf, "union"))


def _trial_rows(spark: SparkSession, sf: str) -> DataFrame:
    points = materialize(two_signals(spark, sf), "pairs")
    scored = outliers.mahalanobis_scores(points, standardize=True).select("doc_id", "md_score")
    scaled = scale(points, fit_scaler(points))
    near = knn_distances(scaled, max(t.k for t in TRIALS), chunk_rows=CELL_ROWS)
    flagged = tuning.trial_flags(materialize(scored.join(near, "doc_id"), "trial-scores"), TRIALS)
    return tuning.trial_rows(flagged, TRIALS, ["doc_id"])


@register
def trial_masks(spark: SparkSession, sf: str) -> DataFrame:
    return _trial_rows(spark, sf)


def _trial_log(spark: SparkSession, sf: str) -> DataFrame:
    """Trials judged by how well their flags tell low-quality documents."""
    judged = (
        _trial_rows(spark, sf)
        .join(_labels(spark, sf), "doc_id")
        .select("trial_number", (1 - F.col("label")).alias("y_true"), F.col("combined_outlier").alias("y_pred"))
    )
    scores = metrics.binary_metrics(judged, ["trial_number"])
    log = tuning.trial_table(spark, TRIALS).join(scores, "trial_number")
    return log.withColumnsRenamed({"accuracy": "mean_acc", "f1": "mean_f1"})


@register
def best_trial(spark: SparkSession, sf: str) -> DataFrame:
    best = reports.best_trial(_trial_log(spark, sf)).drop("precision", "recall")
    return rounded(best, "mean_acc", "mean_f1")


@register
def applied_trial(spark: SparkSession, sf: str) -> DataFrame:
    """One trial's parameters applied to the whole frame."""
    points = materialize(two_signals(spark, sf), "pairs")
    return tuning.clean_with(points, TRIALS[1], chunk_rows=CELL_ROWS).select("doc_id")


@register
def tuning_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report of a finished search: best parameters and scores in one row."""
    log = _trial_log(spark, sf).orderBy("trial_number").collect()
    found = tuning.TuningResult(TRIALS, [r.mean_acc for r in log], [r.mean_f1 for r in log])
    return rounded(found.report(spark), "cv_mean_acc", "cv_mean_f1")


@register
def guarded_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Flags that cover one whole source: there nothing is removed, elsewhere what is flagged."""
    rows = read_table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    flag = ((F.col("source") == "src3") | (F.col("n_chars") > 2000)).cast("int")
    kept = outliers.keep_inliers(rows.withColumn("flag", flag), "flag", "source")
    return kept.select("doc_id", "source")


def _study_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A summary as a study writes it: text length limits stand for the models of its scenarios."""
    names = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(x).alias("limit")) for n, x in STUDY_ROWS])
    lengths = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    judged = _labels(spark, sf).join(lengths, "doc_id").select(
        F.col("label").alias("y_true"), "n_chars", F.inline(names)
    )
    judged = judged.withColumn("y_pred", (F.col("n_chars") > F.col("limit")).cast("int"))
    found = metrics.binary_metrics(judged, ["scenario"])
    return found.select(
        "scenario", F.lit("linear_svc").alias("model"), F.col("accuracy").alias("cv_acc"),
        F.col("f1").alias("cv_f1"), F.col("accuracy").alias("test_accuracy"),
        F.col("f1").alias("test_f1"), F.col("precision").alias("test_precision"),
        F.col("recall").alias("test_recall"), F.lit("nowhere").alias("model_path"),
    )


@register
def cv_table(spark: SparkSession, sf: str) -> DataFrame:
    return reports.cv_table(_study_summary(spark, sf))


@register
def test_table(spark: SparkSession, sf: str) -> DataFrame:
    return reports.test_table(_study_summary(spark, sf))


@register
def trials_by_combine(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.trials_by_combine(_trial_log(spark, sf)), "mean_acc")


@register
def trial_box(spark: SparkSession, sf: str) -> DataFrame:
    box = reports.trial_box(materialize(_trial_log(spark, sf), "trial-log"))
    return rounded(box, *[c for c in box.columns if c not in ("combine", "n_trials")])


# --- splits, folds, distributions ---------------------------------------------------------------


@register
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return folds.stratified_split(_labels(spark, sf))


@register
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return folds.stratified_folds(_labels(spark, sf))


@register
def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.label_counts(_labels(spark, sf))


@register
def split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return reports.split_sizes(workflow.assign_splits(_labels(spark, sf), test_size=0.2))


@register
def trainval_union(spark: SparkSession, sf: str) -> DataFrame:
    return reports.train_and_val(workflow.assign_splits(_labels(spark, sf), test_size=0.2))


@register
def all_splits_union(spark: SparkSession, sf: str) -> DataFrame:
    split = workflow.assign_splits(_labels(spark, sf), test_size=0.2)
    parts = [split.where(F.col("split") == s) for s in ("train", "val", "test")]
    return reports.union_splits(*parts)


# --- metrics --------------------------------------------------------------------------------------


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Second label as a stand-in for a classifier: not toxic means good quality."""
    return read_table(spark, sf, "labels").select(
        "doc_id", F.col("quality").alias("y_true"), (1 - F.col("toxic")).alias("y_pred")
    )


@register
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_matrix(predictions(spark, sf))


@register
def confusion_normalized(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.confusion_matrix(predictions(spark, sf), True), "pred_0", "pred_1")


@register
def binary_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.binary_metrics(predictions(spark, sf)), *metrics.METRIC_NAMES)


@register
def metrics_key_values(spark: SparkSession, sf: str) -> DataFrame:
    return reports.key_values(binary_metrics(spark, sf))


@register
def class_report(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.class_report(predictions(spark, sf))


def _length_rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Fold scores of a rule with one parameter: long documents are good."""
    lengths = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    judged = folds.stratified_folds(_labels(spark, sf)).join(lengths, "doc_id")
    limits = F.posexplode(constant(LENGTH_LIMITS, "int")).alias("grid_idx", "limit")
    said = judged.select("fold", F.col("label").alias("y_true"), "n_chars", limits).withColumn(
        "y_pred", (F.col("n_chars") > F.col("limit")).cast("int")
    )
    return metrics.binary_metrics(said, ["grid_idx", "limit", "fold"])


@register
def cv_mean(spark: SparkSession, sf: str) -> DataFrame:
    means = reports.mean_over_folds(_length_rule_scores(spark, sf), ["grid_idx", "limit"])
    return rounded(means, "mean_acc", "mean_f1")


@register
def best_grid_point(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.best_grid_point(cv_mean(spark, sf)), "mean_acc", "mean_f1")


# --- report tables ----------------------------------------------------------------------------------


def _population(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines in the shape of a search log."""
    return read_table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("generation"),
        F.col("l_discount").alias("score"),
        F.col("l_quantity").cast("int").alias("on_count"),
        F.col("l_orderkey").alias("individual"),
        F.col("l_partkey").alias("tie"),
    )


@register
def generation_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = reports.generation_stats(
        _population(spark, sf), order=("individual", "tie", "on_count")
    )
    return rounded(stats, "best_score", "mean_score")


@register
def search_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.search_report(generation_stats(spark, sf), 50, "accuracy"), "best_score")


@register
def top_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Difference of class means per dimension as a weight vector, ranked by name."""
    rows = embeddings(spark, sf).select("label", F.posexplode("features").alias("idx", "x"))
    high = F.col("label") >= 5
    diff = rows.groupBy("idx").agg(
        (F.avg(F.when(high, F.col("x"))) - F.avg(F.when(~high, F.col("x")))).alias("w")
    )
    # One entry per dimension of the vectors.
    entries = F.sort_array(F.collect_list(F.struct("idx", "w")))
    coefficients = diff.agg(F.transform(entries, lambda e: e["w"]).alias("coefficients"))
    names = diff.select("idx", F.format_string("dim_%02d", "idx").alias("feature"))
    return rounded(reports.top_weights(reports.named_weights(coefficients, names)), "weight")


# --- prompts ------------------------------------------------------------------------------------------


@register
def prompt_train(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepared_corpus(spark, sf)
    made = prompts.training_prompts(prepared.split("train", "val"), prepared.names, top_k=10)
    return normalize_newlines(made)


@register
def prompt_infer(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepared_corpus(spark, sf)
    return prompts.inference_prompts(
        prepared.split("val"), prepared.names, decimals=2, include_engineered=False
    )


@register
def prompt_splits(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepared_corpus(spark, sf, test_size=0.2)
    return prompts.prompt_corpus(prepared.frame, prepared.names)


def generations(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as generated answers; some end in a digit, some hold none."""
    tail = F.when(F.pmod("conv_id", F.lit(3)) < 2, F.pmod("conv_id", F.lit(3)).cast("string"))
    return read_table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.concat(F.col("text"), F.coalesce(tail, F.lit(""))).alias("generated"),
        F.pmod("turn", F.lit(2)).cast("int").alias("y_true"),
    )


@register
def generated_label(spark: SparkSession, sf: str) -> DataFrame:
    label = prompts.generated_label(F.col("generated")).alias("y_pred")
    return generations(spark, sf).select("conv_id", "turn", label)


@register
def generated_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(prompts.judge_generations(generations(spark, sf)), *metrics.METRIC_NAMES)


@register
def generated_report(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.generation_report(generations(spark, sf))


# --- models (checked by properties and brute force in the tests) ------------------------------------------


def _judged(model: models.FittedModel, prepared: workflow.Prepared) -> DataFrame:
    held = metrics.binary_metrics(model.predict(prepared.split("val")))
    return held.select(F.lit(model.model_type).alias("model"), *metrics.METRIC_NAMES)


def _fit(spark: SparkSession, sf: str, model_type: str, params: dict) -> DataFrame:
    prepared = prepared_corpus(spark, sf)
    return _judged(models.fit_final(prepared.split("train"), model_type, params), prepared)


@register
def svm_optimum(spark: SparkSession, sf: str) -> DataFrame:
    """The linear SVM on two signals for several costs: its unique optimum and its accuracy."""
    points = materialize(two_signals(spark, sf).join(_labels(spark, sf), "doc_id"), "svm-pairs")
    costs = {i: svm.Task(c=c) for i, c in enumerate(SVM_COSTS)}
    rows = []
    for i, model in svm.fit_numbered(points, costs).items():
        accuracy = metrics.binary_metrics(model.predict(points)).first().accuracy
        rows.append((SVM_COSTS[i], *map(float, model.coefficients), float(model.intercept), accuracy))
    fitted = spark.createDataFrame(rows, "c double, wx double, wy double, b double, accuracy double")
    return rounded(fitted, "wx", "wy", "b", "accuracy", digits=5)


def _model_checks(spark: SparkSession, sf: str, model_type: str, params: dict) -> DataFrame:
    """Properties of a fit that the tables alone decide: ``(property, value)``."""
    prepared = prepared_corpus(spark, sf, test_size=0.2)
    model = models.fit_final(prepared.split("train"), model_type, params)
    said = materialize(model.predict(prepared.split("val")), "checked-predictions")
    cells = said.agg(
        F.count("*").alias("predictions"),
        F.countDistinct("doc_id").alias("documents"),
        F.sum(F.col("y_true")).alias("positives"),
        F.count_if(F.col("y_pred").isin(0, 1)).alias("zero_or_one"),
        F.count_if(F.col("y_true") == F.col("y_pred")).alias("right"),
    ).first()
    shown = metrics.binary_metrics(said).first().accuracy
    found = {k: int(cells[k]) for k in ("predictions", "documents", "positives", "zero_or_one")}
    found["accuracy_is_right_share"] = int(abs(shown * cells.predictions - cells.right) < 1e-6)
    found["beats_chance"] = int(cells.right * 2 > cells.predictions)
    weights = model.importances()
    if weights and weights[0] == "importance":
        found["importances_sum_to_one"] = int(abs(weights[1].sum() - 1) < 1e-9)
        found["negative_importances"] = int((weights[1] < 0).sum())
    return spark.createDataFrame(list(found.items()), "property string, value long")


@register
def svm_checks(spark: SparkSession, sf: str) -> DataFrame:
    return _model_checks(spark, sf, "linear_svc", {"C": 1.0})


@register
def rbf_checks(spark: SparkSession, sf: str) -> DataFrame:
    return _model_checks(spark, sf, "svc_rbf", {"C": 1.0, "gamma": 0.01})


@register
def forest_checks(spark: SparkSession, sf: str) -> DataFrame:
    return _model_checks(spark, sf, "random_forest", FOREST)


@register
def boosted_checks(spark: SparkSession, sf: str) -> DataFrame:
    return _model_checks(spark, sf, "xgboost", BOOSTED)


@register
def svm_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _fit(spark, sf, "linear_svc", {"C": 1.0})


@register
def rbf_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _fit(spark, sf, "svc_rbf", {"C": 1.0, "gamma": 0.01})


@register
def forest_fit(spark: SparkSession, sf: str) -> DataFrame:
    params = FOREST
    return _fit(spark, sf, "random_forest", params)


@register
def boosted_fit(spark: SparkSession, sf: str) -> DataFrame:
    params = {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0}
    return _fit(spark, sf, "xgboost", params)


@register
def boosted_first_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The first split of every column for returned lines: quantity, discount and tax."""
    columns = ("l_quantity", "l_discount", "l_tax")
    lines = read_table(spark, sf, "lineitem").select(
        F.array(*(F.col(c).cast("double") for c in columns)).alias("features"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )
    found = boosting.first_splits(lines, boosting.Boosting(learning_rate=0.1))
    return rounded(found, "gain", "left_value", "right_value")


@register
def grid_search(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepared_corpus(spark, sf)
    return models.cv_search(prepared.split("train"), "linear_svc").table(spark)


@register
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepared_corpus(spark, sf)
    model = models.fit_final(prepared.split("train"), "linear_svc", {"C": 1.0})
    return reports.top_weights(model.weights_table(spark, prepared.names))


@register
def train_and_judge(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepared_corpus(spark, sf, test_size=0.2)
    return workflow.train_and_judge(prepared, "linear_svc", None, 5)[1]


@register
def outlier_tuning(spark: SparkSession, sf: str) -> DataFrame:
    train = prepared_corpus(spark, sf).split("train")
    return tuning.tune_outliers(train, tuning.random_trials()).table(spark)


@register
def subset_search(spark: SparkSession, sf: str) -> DataFrame:
    train = prepared_corpus(spark, sf).split("train")
    found = search_subset(train, Breeding(pop_size=8, generations=2), Scoring(n_splits=3))
    return found.history_table(spark)


@register
def experiment_suite(spark: SparkSession, sf: str) -> DataFrame:
    """All four model types in all scenarios, with a tuned trial and a searched subset."""
    prepared = prepared_corpus(spark, sf, test_size=0.2)
    train = prepared.split("train").drop("split")
    trial = tuning.tune_outliers(train, tuning.random_trials()).best
    cleaned = materialize(workflow.clean_with(train, trial), "suite-clean")
    found = search_subset(cleaned)
    grids = {
        "linear_svc": {"C": [0.5, 1.0]},
        "svc_rbf": {"C": [1.0], "gamma": [0.01]},
        "random_forest": {"n_estimators": [5], "max_depth": [5], "min_samples_leaf": [1]},
        "xgboost": {"n_estimators": [3], "max_depth": [2], "learning_rate": [0.2], "subsample": [1.0]},
    }
    mask = [bool(b) for b in found.mask]
    return workflow.experiment_suite(prepared, trial, mask, grids)[0]


@register
def cleaned_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: texts -> features -> outlier scores -> clean train rows."""
    return workflow.cleaned_corpus(labelled(spark, sf), tfidf=TFIDF)
