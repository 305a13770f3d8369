import numpy as np
import pytest

from docsignal.llm import langid
from docsignal.llm.queries import op7_language_id
from helpers import documents, edge_rows, empty

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return langid.learn(docs.where(~langid.held_out()))


def test_held_out_accuracy(spark):
    found = op7_language_id(spark, DATA).where("held_out")
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_counts_equal_a_plain_count(spark):
    docs = documents(spark, [(1, "ab ab", "x"), (2, "Abc", "x"), (3, "ä", "y"), (4, None, "x"), (5, "z", None)])
    model = langid.learn(docs)
    assert model.names == ["x", "y"]

    def bucket(gram):
        code = int.from_bytes(gram, "big")
        return ((code * 2654435761) % 2**32) >> 16

    counts = {}
    for word in (b"ab", b"ab", b"abc"):
        padded = b" " + word + b" "
        for i in range(len(word)):
            counts[bucket(padded[i : i + 3])] = counts.get(bucket(padded[i : i + 3]), 0) + 1
    table = np.full(langid.BUCKETS, langid.SMOOTHING)
    for b, n in counts.items():
        table[b] += n
    assert np.allclose(model.table[:, 0], np.log(table / table.sum()), atol=1e-5)


def test_mixtures_are_found(spark, model):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) > 1500")
    one = {r.lang: r.text[:1200] for r in docs.orderBy("doc_id").collect()}
    rows = [(1, one["en"] + "\n" + one["fr"]), (2, one["de"]), (3, one["es"] + " " + one["de"][:500])]
    found = {r.doc_id: r for r in langid.predict(documents(spark, rows), model).collect()}
    assert set(found[1].langs) == {"en", "fr"} and abs(sum(found[1].proportions) - 1) < 1e-6
    assert found[2].langs == ["de"] and found[2].score > 0.9
    assert found[3].langs == ["es", "de"]


def test_estimate_equals_plain_expectation_maximisation():
    rng = np.random.default_rng(1)
    likelihood, size = rng.random((30, 3)), np.array([10, 20])
    first = np.array([0, 10])
    got, value = langid.estimate(likelihood, first, size, np.full((2, 3), 1 / 3), 5)
    for d in range(2):
        own, w = likelihood[first[d] : first[d] + size[d]], np.full(3, 1 / 3)
        for _ in range(5):
            r = own * w
            w = (r / r.sum(1, keepdims=True)).mean(0)
        assert np.allclose(got[d], w) and np.isclose(value[d], np.log((own * w).sum(1)).sum())


def test_a_larger_set_is_not_left_out_for_an_estimate_that_has_not_converged():
    words = np.full((200, 102), np.log(0.6))
    words[:100, 0], words[100:, 0] = 0.0, np.log(0.4)
    words[:100, 1], words[100:, 1] = np.log(0.4), 0.0
    proportions, chosen = langid.infer(words, np.zeros(200, int), 1, langid.PENALTY)
    assert np.flatnonzero(chosen[0]).tolist() == [0, 1] and np.allclose(proportions[0, :2], 0.5)


def test_the_bound_holds_for_converged_estimates():
    rng = np.random.default_rng(3)
    likelihood, size, first = rng.random((60, 8)), np.array([20, 40]), np.array([0, 20])
    even = np.full((2, 8), 1 / 8)
    weights, value = langid.estimate(likelihood, first, size, even)
    _, converged = langid.estimate(likelihood, first, size, even, 5000)
    bound = langid.most_likely(likelihood, first, size, weights, value)
    assert (value < converged).all() and (converged <= bound + 1e-9).all()


def test_edges(spark, model):
    rows = edge_rows()
    found = langid.predict(documents(spark, rows, clashing=True), model).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    for key in (1, 2, 3, 10):
        assert (by[key].lang_pred, by[key].score, by[key].langs) == ("und", 0.0, [])
    assert by[9].lang_pred != "und"  # letters beyond ASCII count
    assert langid.predict(empty(spark), model).count() == 0
    nothing = langid.identify(documents(spark, [(0, "some words", None)]))
    assert nothing.first().lang_pred == "und"
    assert langid.identify(empty(spark)).count() == 0
