import collections

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import test_exact as exact_tests
import test_jaccard as jaccard_tests
import test_suffixes as suffix_tests
from docsignal.llm import langid
from docsignal.llm.common import read
from helpers import DOCUMENTS, edge_rows, documents, empty

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, over the small documents."""
    out, place = {}, tmp_path_factory.mktemp("pipeline")
    docs = read(spark, SMALL, "documents")
    out["input"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
        out[name] = docs.collect()
    return out


def pairs(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_language(spark, stages):
    docs = read(spark, SMALL, "documents")
    model = langid.learn(docs.where(~langid.held_out()))
    verdict = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    stay = {k for k, r in verdict.items() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SHARE}
    assert {r.doc_id for r in stages["language"]} == stay
    assert set(stages["language"]) <= set(stages["input"])


def test_language_keeps_documents_in_many_languages(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    one = {r.lang: r.text[:1200] for r in docs.where("length(text) > 1500").orderBy("doc_id").collect()}
    assert len(one) == 4
    every = documents(spark, [(-1, "\n".join(one.values())), (-2, "12345 --- !!!")])
    # The same language under four regional labels: no label has a large share.
    english = docs.where("lang = 'en' and length(text) > 400").withColumn("lang", F.concat(F.lit("en-"), (F.col("doc_id") % 4).cast("string")))
    mixed = corpus_pipeline.language(spark, docs.unionByName(every), "")
    assert {r.doc_id for r in mixed.where("doc_id < 0").collect()} == {-1}
    assert corpus_pipeline.language(spark, english, "").count() == english.count()


def test_exact(stages):
    want = {r[0] for r in exact_tests.plain(pairs(stages["language"])) if r[3]}
    assert sorted(r.doc_id for r in stages["exact"]) == sorted(want)
    assert set(stages["exact"]) <= set(stages["input"])


def test_near(stages):
    want = {r[0] for r in jaccard_tests.plain(pairs(stages["exact"])) if r[0] == r[2]}
    assert sorted(r.doc_id for r in stages["near"]) == sorted(want)
    assert set(stages["near"]) <= set(stages["input"])


def test_passages(stages):
    want = {r[0]: r[3].decode("utf-8", "ignore") for r in suffix_tests.plain(pairs(stages["near"]), 50)}
    assert {r.doc_id: r.text for r in stages["passages"]} == want
    assert all(r.n_chars == len(r.text) for r in stages["passages"])


def test_packing(stages):
    tokens = collections.Counter()
    for r in stages["packing"]:
        tokens[r.doc_id] += r.length
    assert set(tokens) == {r.doc_id for r in stages["passages"]}
    assert all(tokens[r.doc_id] == r.doc_tokens for r in stages["packing"])


def test_run_gives_the_same(spark, stages):
    found = corpus_pipeline.run(spark, SMALL).select("doc_id", "start", "length", "ids_crc32")
    want = collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in stages["packing"])
    total = collections.Counter(tuple(r) for r in found.collect())
    assert sum(n * k[2] for k, n in total.items()) == sum(n * k[2] for k, n in want.items())


def test_columns_and_edges(spark, tmp_path):
    columns = [c.split()[0] for c in DOCUMENTS.split(", ")]
    for n, docs in enumerate([documents(spark, edge_rows(), clashing=True), empty(spark)]):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, "").write.parquet(f"{tmp_path}/{n}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{name}")
            if name != "packing":
                assert docs.columns == columns
            docs.count()
