import random

import pytest
from frames import as_dicts
from pyspark.sql import functions as F

from docsignal.functions.numeric import coerce_features, recode, round_numbers, rounded_text
from docsignal.operators import frame, models, prompts
from docsignal.operators.outliers import OutlierConfig
from docsignal.operators.tfidf import TfidfConfig
from docsignal.plans import workflow
from docsignal.sources import sinks, tables
from docsignal.streaming import scoring

NAMES = ["char_len", "vader_compound", "tfidf:a:b", "tfidf:cats", "tfidf:dogs"]


def rows(spark):
    data = [
        (1, 1, "train", [12.0, -0.00001, 0.5, 0.25, 0.5]),
        (2, 0, "test", [1234567.0625, 0.1234, 0.0, 0.0, 0.0]),
    ]
    return spark.createDataFrame(data, "doc_id int, label int, split string, features array<double>")


def test_prompt_texts(spark):
    got = as_dicts(prompts.training_prompts(rows(spark), NAMES, top_k=2))
    assert got[1]["prompt"] == (
        prompts.INSTRUCTION + "\n\nSIGNALS:\nEngineered: char_len=12.0, vader_compound=-0.0\n"
        "Top-TFIDF: a:b:0.5, dogs:0.5\n\nAnswer: 1"
    )
    assert "char_len=1234567.062, vader_compound=0.123\n\nAnswer: 0" in got[2]["prompt"]
    bare = as_dicts(prompts.inference_prompts(rows(spark), NAMES, include_engineered=False))
    assert bare[2]["prompt"].endswith("SIGNALS:\nNo signals.\n\nAnswer:")
    assert bare[1]["prompt"].endswith("Top-TFIDF: a:b:0.5, dogs:0.5, cats:0.25\n\nAnswer:")
    corpus = as_dicts(prompts.prompt_corpus(rows(spark), NAMES, top_k=0))
    assert corpus[1]["prompt"].endswith("vader_compound=-0.0\n\nAnswer: 1")
    assert corpus[2]["prompt"].endswith("Answer:")
    none = prompts.inference_prompts(rows(spark), ["x"]).first().prompt
    assert "No signals." in none


def test_numbers_print_as_python_prints_them(spark):
    rng = random.Random(4)
    values = [0.0, -0.0, 0.0625, 0.1875, 2.6755, 0.0025, 0.0015, 1e7, 123456789.125, -0.0004, 5e-324]
    values += [rng.uniform(-200, 200) for _ in range(2000)] + [rng.randint(-9999, 9999) / 16 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 3):
        for r in df.select("v", rounded_text(F.col("v"), digits).alias("s")).collect():
            assert r.s == repr(round(r.v, digits)), r.v


def test_generated_labels(spark):
    df = spark.createDataFrame(
        [("  1", 1), ("x 0 1", 0), ("none", 1), ("", 0), ("10", 0)], "generated string, y_true int"
    )
    said = [r[0] for r in df.select(prompts.generated_label(F.col("generated"))).collect()]
    assert said == [1, 0, None, None, 1]
    judged = prompts.judge_generations(df).first()
    assert (judged.n_rows, judged.n_unreadable) == (5, 2)
    assert judged.accuracy == pytest.approx(2 / 5)
    assert prompts.generation_report(df).where("name = 'accuracy'").first().support == 5


def test_coercion(spark):
    df = spark.createDataFrame(
        [(1, "2.5", float("nan"), "1"), (2, "x", None, "0.0"), (3, None, 4.0, "1")],
        "doc_id int, a string, b double, label string",
    )
    got = [tuple(r) for r in coerce_features(df, keys=["doc_id"]).orderBy("doc_id").collect()]
    assert got == [(1, 2.5, 0.0, 1), (2, 0.0, 0.0, 0), (3, 0.0, 4.0, 1)]
    for bad in ("yes", None):
        broken = spark.createDataFrame([(1, "1", bad)], "doc_id int, a string, label string")
        with pytest.raises(Exception):
            coerce_features(broken, keys=["doc_id"]).collect()
    kept = df.select(recode(F.col("a"), {"x": "y"}).alias("a")).collect()
    assert [r.a for r in kept] == ["2.5", "y", None]
    assert round_numbers(spark.createDataFrame([(1, 0.126)], "i int, v double"), 2).first().v == 0.13


def test_columns_and_masks(spark):
    wide = spark.createDataFrame([(1, 0.5, 0.25, 9.0, 1)], "doc_id int, char_len double, `tfidf:a` double, x double, label int")
    assert frame.align_columns(wide, ["x", "label"]).columns == ["x", "label"]
    with pytest.raises(ValueError):
        frame.align_columns(wide, ["gone", "x"])
    assert frame.drop_engineered(wide, keys=["doc_id"]).columns == ["doc_id", "tfidf:a", "x", "label"]
    masked = frame.mask_columns(wide.withColumnRenamed("tfidf:a", "t"), [True, False, True], keys=["doc_id"])
    assert masked.columns == ["doc_id", "char_len", "x", "label"]
    long = frame.long_features(rows(spark), NAMES)
    assert frame.keep_features(long, ["char_len"]).count() == 2
    with pytest.raises(ValueError):
        tables.require_columns(wide, ["news"])


def test_csv_round_trip_and_standard_names(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = spark.createDataFrame(
        [(7, 'a "quoted"\nline, two', 1), (8, "b", 0)], "`Unnamed: 0` long, news string, label int"
    )
    sinks.write_csv(raw, path)
    sinks.write_csv(raw, path)  # replaces
    back = tables.read_csv(spark, path, tables.RAW_SCHEMA)
    got = as_dicts(tables.standardize(back))
    assert got[7] == {"doc_id": 7, "text": 'a "quoted"\nline, two', "label": 1}
    with pytest.raises(ValueError):
        tables.read_csv(spark, path, "missing string")
    unkeyed = tables.standardize(raw.drop("Unnamed: 0"))
    assert unkeyed.select("doc_id").distinct().count() == 2
    with pytest.raises(ValueError):
        tables.standardize(raw.drop("label"))


def test_optional_artefacts_and_json(spark, tmp_path):
    assert tables.read_or_empty(spark, str(tmp_path / "absent"), "a int").count() == 0
    made = prompts.training_prompts(rows(spark), NAMES).withColumn("prompt", F.lit("x\r\ny\rz"))
    sinks.write_prompts(made, str(tmp_path / "prompts"))
    back = spark.read.json(str(tmp_path / "prompts"))
    assert {r.prompt for r in back.collect()} == {"x\ny\nz"}
    scored = spark.createDataFrame([(1, 1), (2, 0)], "doc_id int, combined_outlier int")
    sinks.write_removed(scored, str(tmp_path / "removed"))
    assert [r.doc_id for r in spark.read.parquet(str(tmp_path / "removed")).collect()] == [1]
    assert tables.read_or_empty(spark, str(tmp_path / "removed"), "doc_id int").count() == 1


def corpus(spark, n=60):
    rng = random.Random(0)
    good, bad = ["calm", "honest", "clear", "true"], ["SCAM", "fake", "hate", "click!"]
    data = []
    for i in range(n):
        label = i % 2
        pool = (good if label else bad) + ["the", "news", "today", "it", "is"]
        data.append((i, " ".join(rng.choices(pool, k=rng.randint(5, 30))) + ".", label))
    return spark.createDataFrame(data, "doc_id long, text string, label int")


SMALL = TfidfConfig(max_terms=8, char_fallback=False)


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    docs = corpus(spark, 30)
    model = frame.fit_features(docs, SMALL)
    classifier = models.fit_final(model.transform(docs), "linear_svc", {"C": 1.0})
    source = str(tmp_path / "in")
    docs.repartition(3).write.parquet(source)
    schema = docs.schema
    stream = scoring.read_text_stream(spark, source, schema=schema)
    jobs = {
        "scored": scoring.score_stream(stream, model),
        "prompted": scoring.prompt_stream(stream, model),
        "predicted": scoring.predict_stream(stream, model, classifier),
    }
    for name, out in jobs.items():
        query = out.writeStream.format("memory").queryName(name).outputMode("append").start()
        query.processAllAvailable()
        query.stop()
    batch = model.transform(docs)
    assert as_dicts(spark.table("scored")) == as_dicts(batch)
    assert as_dicts(spark.table("prompted")) == as_dicts(prompts.inference_prompts(batch, model.names))
    assert as_dicts(spark.table("predicted")) == as_dicts(classifier.predict(batch))


def test_experiment_suite(spark, tmp_path):
    prepared = workflow.prepare(workflow.assign_splits(corpus(spark), test_size=0.25), SMALL)
    sizes = {r.split: r["count"] for r in prepared.frame.groupBy("split").count().collect()}
    assert sizes == {"train": 36, "val": 8, "test": 16}
    mask = [i % 2 == 0 for i in range(len(prepared.names))]
    from docsignal.operators.tuning import Trial

    table, fitted = workflow.experiment_suite(
        prepared, Trial(2.0, 2.0, 3), mask, {"linear_svc": {"C": [1.0]}}, n_splits=2,
        out_dir=str(tmp_path / "models"),
    )
    got = as_dicts(table, "scenario")
    assert set(got) == {
        "baseline_linear_svc", "cleaned_only_linear_svc", "selected_linear_svc",
        "selected_no_engineered_linear_svc",
    }
    assert got["baseline_linear_svc"]["test_accuracy"] > 0.8
    again = models.load_model(spark, got["baseline_linear_svc"]["model_path"])
    test = prepared.split("test")
    assert models.evaluate(again, test)["accuracy"] == got["baseline_linear_svc"]["test_accuracy"]
    clean = workflow.cleaned_corpus(corpus(spark), OutlierConfig(k=3), SMALL)
    assert 0 < clean.count() <= 48


def test_train_judge_and_save(spark, tmp_path):
    prepared = workflow.prepare(workflow.assign_splits(corpus(spark), test_size=0.25), SMALL)
    model, table = workflow.train_and_judge(prepared, "linear_svc", {"C": [1.0]}, 2)
    assert {r.judged for r in table.collect()} == {"val_held_out", "val_in_sample", "test"}
    path = str(tmp_path / "run")
    workflow.save_evaluation(model, prepared.split("test"), path)
    saved = spark.read.json(f"{path}/metrics").first()
    assert saved.test_accuracy == table.where("judged = 'test'").first().accuracy
    assert spark.read.option("header", True).csv(f"{path}/confusion").count() == 2
    prepared.model.save(spark, f"{path}/features")
    again = frame.FeatureModel.load(spark, f"{path}/features")
    docs = corpus(spark, 10).drop("label")
    assert as_dicts(again.transform(docs)) == as_dicts(prepared.model.transform(docs))


def test_full_study(spark):
    from docsignal.operators.selection import Breeding, Scoring
    from docsignal.operators.tuning import random_trials

    table, fitted = workflow.full_study(
        corpus(spark), {"linear_svc": {"C": [1.0]}}, trials=random_trials(2, k=(2, 4)),
        breeding=Breeding(pop_size=3, generations=1, min_features=3), scoring=Scoring(n_splits=2),
        tfidf=SMALL,
    )
    assert table.count() >= 3 and len(fitted) == table.count()


def test_csv_is_parsed_once_and_spread(spark, tmp_path):
    rows = [(i, f"line one\nline \"two\" of {i}", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, news string, label int")
    df.coalesce(1).write.options(header=True, escape='"').csv(str(tmp_path / "raw"))
    found = tables.import_csv(spark, str(tmp_path / "raw"), "id int, news string, label int", 5)
    assert found.rdd.getNumPartitions() >= 2
    assert all(f.endswith(".parquet") for f in found.inputFiles())
    assert sorted(map(tuple, found.collect())) == sorted(rows)
    with pytest.raises(ValueError):
        tables.import_csv(spark, str(tmp_path / "raw"), "id int, other string")


def test_a_table_is_dealt_out_by_key(spark, tmp_path):
    spark.range(50).withColumnRenamed("id", "doc_id").coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    whole, dealt = (tables.read_table(spark, str(tmp_path), "t", n) for n in (None, 6))
    assert (whole.rdd.getNumPartitions(), dealt.rdd.getNumPartitions()) == (1, 6)
    assert sorted(whole.collect()) == sorted(dealt.collect())
