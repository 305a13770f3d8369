import math
import random
import re
from collections import Counter, defaultdict

import pytest

from docsignal.operators import tfidf
from docsignal.operators.frame import FeatureModel, fit_features, long_features
from docsignal.operators.tfidf import TfidfConfig, TfidfModel, fit_tfidf, tfidf_rows

CORPUS = [(0, "Cats and dogs and cats"), (1, "dogs bark"), (2, "a cat"), (3, "cats bark, cats BARK")]
OPEN = TfidfConfig(max_terms=None, char_fallback=False)


def corpus(spark, rows=CORPUS):
    return spark.createDataFrame(rows, "doc_id int, text string")


def test_golden_weights(spark):
    model = fit_tfidf(corpus(spark), OPEN)
    assert model.terms == ["bark", "cats", "dogs"]
    assert model.df == [2, 2, 2]
    assert model.idf == pytest.approx([1.510826] * 3, abs=1e-6)
    rows = {(r.doc_id, r.term): r.value for r in tfidf_rows(corpus(spark), model).collect()}
    want = {
        (0, "cats"): 0.894427, (0, "dogs"): 0.447214, (1, "bark"): 0.707107, (1, "dogs"): 0.707107,
        (3, "bark"): 0.707107, (3, "cats"): 0.707107,
    }
    assert rows == pytest.approx(want, abs=1e-6)


def test_limit_prefers_frequent_terms_then_alphabet(spark):
    model = fit_tfidf(corpus(spark), TfidfConfig(max_terms=2, min_df=1, char_fallback=False))
    assert model.terms == ["bark", "cats"]  # cats 4, bark 3, then and/dogs


def test_share_bounds_and_bad_bounds(spark):
    model = fit_tfidf(corpus(spark), TfidfConfig(None, 0.5, 0.5, char_fallback=False))
    assert model.terms == ["bark", "cats", "dogs"]
    with pytest.raises(ValueError):
        fit_tfidf(corpus(spark), TfidfConfig(None, 3, 0.25, char_fallback=False))


def test_small_vocabulary_falls_back_to_characters(spark):
    model = fit_tfidf(corpus(spark), TfidfConfig(max_terms=8))
    assert model.config.analyzer == "char"
    grams = defaultdict(Counter)
    for key, text in CORPUS:
        t = text.lower()
        for n in (3, 4, 5):
            grams[key].update(t[i : i + n] for i in range(len(t) - n + 1))
    df = Counter(g for c in grams.values() for g in c)
    tf = sum(grams.values(), Counter())
    want = sorted(sorted((g for g in df if df[g] >= 2), key=lambda g: (-tf[g], g))[:8])
    assert model.terms == want


def test_char_ngrams_keep_characters_whole(spark):
    rows = [(0, "a😀b😀c"), (1, "x  \t y😀b😀c")]
    model = fit_tfidf(corpus(spark, rows), TfidfConfig(None, 1, analyzer="char", ngram_range=(3, 3)))
    want = {"a😀b", "😀b😀", "b😀c", "x y", " y😀", "y😀b"}
    assert set(model.terms) == want


def test_bigrams_against_plain_python(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["aa", "bb", "cc", "dd"], k=rng.randint(0, 6)))) for i in range(60)]
    model = fit_tfidf(corpus(spark, rows), TfidfConfig(None, 1, ngram_range=(1, 2), char_fallback=False))
    counts = {}
    for key, text in rows:
        w = text.split()
        counts[key] = Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    df = Counter(t for c in counts.values() for t in c)
    assert dict(zip(model.terms, model.df)) == dict(df)
    idf = {t: math.log((1 + 60) / (1 + d)) + 1 for t, d in df.items()}
    got = {(r.doc_id, r.term): r.value for r in tfidf_rows(corpus(spark, rows), model).collect()}
    for key, c in counts.items():
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        for t, n in c.items():
            assert got[key, t] == pytest.approx(n * idf[t] / norm)
    assert len(got) == sum(map(len, counts.values()))


def test_unseen_text_and_no_terms(spark):
    model = fit_tfidf(corpus(spark), OPEN)
    fresh = corpus(spark, [(9, "birds sing"), (10, None), (11, "DOGS")])
    assert [(r.doc_id, r.term, r.value) for r in tfidf_rows(fresh, model).collect()] == [(11, "dogs", 1.0)]
    none = fit_tfidf(corpus(spark), TfidfConfig(max_terms=0))
    assert FeatureModel(none).transform(fresh).first().features[0] >= 0
    assert len(FeatureModel(none).names) == 20


def test_save_and_load_replaces_target(spark, tmp_path):
    path = str(tmp_path / "model")
    model = fit_tfidf(corpus(spark), OPEN)
    model.save(spark, path)
    model.save(spark, path)
    again = TfidfModel.load(spark, path)
    assert (again.terms, again.idf, again.n_docs) == (model.terms, model.idf, 4)
    assert again.config == OPEN


def test_partitions_and_order_do_not_matter(spark):
    frames = [corpus(spark).repartition(n) for n in (1, 7)]
    models = [fit_features(f, OPEN) for f in frames]
    assert models[0].tfidf == models[1].tfidf
    rows = [
        sorted(map(tuple, long_features(m.transform(f), m.names, ["doc_id"]).collect()))
        for m, f in zip(models, frames)
    ]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("config", [
    tfidf.TfidfConfig(5), tfidf.TfidfConfig(40, 1), tfidf.TfidfConfig(40, 3, 0.5),
    tfidf.TfidfConfig(30, analyzer="char", ngram_range=(3, 5)), tfidf.TfidfConfig(100_000, 1),
])
@pytest.mark.parametrize("buckets, share", [(1 << 16, 16), (7, 3), (64, 10_000_000)])
def test_candidates_hold_the_whole_vocabulary(spark, monkeypatch, config, buckets, share):
    chance = random.Random(6)
    names = [f"word{chance.randrange(90)}x" for _ in range(400)]  # many ties of count
    rows = [(" ".join(chance.choices(names, k=chance.randrange(0, 30))),) for _ in range(150)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "text string")
    monkeypatch.setattr(tfidf, "COUNT_BUCKETS", buckets)
    monkeypatch.setattr(tfidf, "GUESS_SHARE", share)
    whole = tfidf.select_vocabulary(tfidf.term_statistics(df, config), len(rows), config)
    found = tfidf.select_vocabulary(tfidf.candidate_statistics(df, len(rows), config), len(rows), config)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


def test_few_terms_are_counted_by_name(spark):
    chance = random.Random(7)
    rows = [(" ".join(f"t{int(40 * chance.paretovariate(0.7))}" for _ in range(200)),) for _ in range(400)]
    df, config = spark.createDataFrame(rows, "text string"), tfidf.TfidfConfig(50)
    everything = tfidf.term_statistics(df, config).count()
    counted = tfidf.candidate_statistics(df, len(rows), config).count()
    assert 50 <= counted <= everything / 10
    assert tfidf.candidate_statistics(df.where("false"), 0, config).count() == 0


@pytest.mark.parametrize("analyzer, sizes", [("word", (1, 2)), ("word", (2, 9)), ("char", (3, 5)), ("char", (2, 12))])
@pytest.mark.parametrize("portion", [1, 70, 1 << 21])
def test_terms_are_counted_by_portions(spark, monkeypatch, analyzer, sizes, portion):
    chance = random.Random(9)
    letters = ["ab", "cdé", "\U0001d49c\U0001d49cx", "中文", "ee\x00f", *[f"w{i}" for i in range(200)]]
    texts = [" ".join(chance.choices(letters, k=chance.randrange(0, 40))) for _ in range(40)] + ["ab", "", None, "a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    monkeypatch.setattr(tfidf, "PORTION_ITEMS", portion)
    config = TfidfConfig(None, 1, analyzer=analyzer, ngram_range=sizes)
    grams = []
    for text in texts:
        items = re.findall(r"\w{2,}", text or "") if analyzer == "word" else (text or "")
        runs = [items[i : i + n] for n in range(sizes[0], sizes[1] + 1) for i in range(len(items) - n + 1)]
        grams.append(Counter(r if analyzer == "char" else " ".join(r) for r in runs))
    df_of, tf_of = Counter(t for g in grams for t in g), sum(grams, Counter())
    found = tfidf.term_statistics(df, config).collect()
    assert {r.term: (r.df, r.tf_total) for r in found} == {t: (df_of[t], tf_of[t]) for t in tf_of}
    assert len(found) == len(tf_of)


def test_a_portion_gives_a_term_once(spark):
    """Before, every occurrence of a term was a row on its way to the counting."""
    df = spark.createDataFrame([("many words and many more words",)] * 300, "text string").coalesce(1)
    for config, kinds in ((TfidfConfig(), 4), (TfidfConfig(analyzer="char", ngram_range=(3, 5)), 70)):
        assert tfidf._occurrences(df, config, "text").count() <= kinds


def test_only_known_characters_are_kept(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "PORTION_ITEMS", 12)
    config = TfidfConfig(analyzer="char", ngram_range=(3, 4))
    df = corpus(spark, [*CORPUS, (4, None), (5, "zzz")])
    rows = tfidf.with_terms(df, config, known=["cat", "cats", "gone"]).collect()
    assert [tuple(r)[:2] for r in sorted(rows)] == [*CORPUS, (4, None), (5, "zzz")]
    assert {r.doc_id: Counter(r._terms) for r in rows} == {
        0: {"cat": 2, "cats": 2}, 1: {}, 2: {"cat": 1}, 3: {"cat": 2, "cats": 2}, 4: {}, 5: {},
    }
