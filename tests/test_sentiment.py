import pytest
from pyspark.sql import functions as F

from docsignal.functions.sentiment import DEMO_LEXICON, lowered, raised, read_lexicon, with_sentiment

# Published scores of sentences whose words the demonstration lexicon covers.
PUBLISHED = {
    "The book was good.": (0.492, 0.508, 0.0, 0.4404),
    "The book was kind of good.": (0.343, 0.657, 0.0, 0.3832),
    "At least it isn't a horrible book.": (0.322, 0.678, 0.0, 0.431),
    "": (0.0, 0.0, 0.0, 0.0),
}


def compound(spark, *texts, lexicon=None):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return {r.text: r for r in with_sentiment(df, lexicon=lexicon).collect()}


def test_published_scores(spark):
    got = compound(spark, *PUBLISHED)
    for text, want in PUBLISHED.items():
        r = got[text]
        assert (r.vader_pos, r.vader_neu, r.vader_neg, r.vader_compound) == want


def test_rules_move_scores_the_right_way(spark):
    texts = [
        "a good day", "a very good day", "a slightly good day", "not a good day", "a GOOD day",
        "a good day!!!", "a good day!!!!!!!!", "no good day", "good but bad", "bad but good",
        "never so good", "without doubt good", "it was the least good", "we yeah right there ok bad",
        "GOOD DAY", "isn't good",
    ]
    s = {t: r.vader_compound for t, r in compound(spark, *texts).items()}
    assert s["a very good day"] > s["a good day"] > s["a slightly good day"] > 0
    assert s["not a good day"] < 0 and s["no good day"] < 0 and s["isn't good"] < 0
    assert s["a GOOD day"] > s["a good day"]
    assert s["GOOD DAY"] == s["a good day"]  # all capitals carry no emphasis
    assert s["a good day!!!"] > s["a good day"]
    assert s["a good day!!!!!!!!"] == compound(spark, "a good day!!!!")["a good day!!!!"].vader_compound
    assert s["good but bad"] < 0 < s["bad but good"]
    assert s["never so good"] > 0 and s["without doubt good"] > 0
    assert s["it was the least good"] < 0


def test_lexicon_is_an_input_table(spark):
    table = spark.createDataFrame([("zorp", 2.0), (":-(", -1.0)], "token string, valence double")
    lexicon = read_lexicon(table)
    got = compound(spark, "zorp", ":-( there", "good", lexicon=lexicon)
    assert got["zorp"].vader_compound == pytest.approx(round(2 / (4 + 15) ** 0.5, 4))
    assert got[":-( there"].vader_compound < 0
    assert got["good"].vader_compound == 0.0


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([(w + " word here",) for w in DEMO_LEXICON], "text string")
    for r in with_sentiment(df).collect():
        assert r.vader_pos + r.vader_neu + r.vader_neg == pytest.approx(1.0, abs=2e-3)


def test_a_score_does_not_depend_on_the_texts_beside_it(spark, monkeypatch):
    monkeypatch.setattr("docsignal.functions.batches.portions.__defaults__", (5,))
    texts = ["not", "good", "very", "a GOOD ÉTÉ day", "", "but", "bad but good", "kind", "of good", "(no)", "yeah", "right", "K :)"]
    together = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = {r.text: r.vader_compound for r in with_sentiment(together).collect()}
    for t in texts:
        alone = spark.createDataFrame([(t,)], "text string")
        assert got[t] == with_sentiment(alone).first().vader_compound, t
    assert got["good"] > 0 and got["of good"] > 0 and got["not"] == 0 and got["right"] == 0


def test_every_character_is_cased_as_by_spark(spark):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["x" + " ".join(map(chr, points[i : i + 2000])) for i in range(0, len(points), 2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", F.lower("t").alias("low"), F.upper("t").alias("high")).collect():
        assert (lowered(r.t), raised(r.t)) == (r.low, r.high)
