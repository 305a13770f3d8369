import collections
import math
import random
import re

from docsignal.llm import rules
from helpers import WORD, bag, documents, edge_rows, empty, words


def plain(text):
    w = WORD.findall(text or "")
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    cover = set()
    for i in range(len(w) - 2):
        if seen[(w[i], w[i + 1], w[i + 2])] > 1:
            cover.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(cover)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def corpus():
    chance = random.Random(3)
    rows = []
    for i in range(120):
        w = words(i, chance.randrange(0, 120), 12 if i % 3 == 0 else 300)
        w = [x + chance.choice(["", "", "!", "#", "\n"]) for x in w]
        rows.append((i, chance.choice([" ", "  ", "\t"]).join(w)))
    return rows + [(1000, "a b c a b c a"), (1001, "a a a a"), (1002, "x\ny\nx\n\n \nx"), (1003, "a\xa0b c")]


def test_signals_equal_a_plain_count(spark):
    rows = corpus() + [r[:2] for r in edge_rows()]
    got = rules.signals(documents(spark, rows, clashing=True)).select("doc_id", *NAMES)
    assert bag(got) == sorted(((k, *plain(t)) for k, t in rows), key=repr)


def plain_fit(patterns, steps):
    """The same estimation over {votes: n} in plain Python."""
    names = len(next(iter(patterns)))
    post = {p: (1 - rules.DOUBT) ** sum(v < 0 for v in p) for p in patterns}
    for _ in range(steps):
        n, good = sum(patterns.values()), sum(patterns[p] * post[p] for p in patterns)
        share = (good + 1) / (n + 2)
        table = {}
        for r in range(names):
            for v in (-1, 0, 1):
                one = sum(patterns[p] * post[p] for p in patterns if p[r] == v)
                both = sum(patterns[p] for p in patterns if p[r] == v)
                table[r, v] = (one + 1) / (good + 3), (both - one + 1) / (n - good + 3)
        for p in patterns:
            a, b = math.log(share), math.log(1 - share)
            for r, v in enumerate(p):
                a, b = a + math.log(table[r, v][0]), b + math.log(table[r, v][1])
            post[p] = 1 / (1 + math.exp(b - a))
    return share, post


def test_estimation_equals_plain_python(spark):
    chance = random.Random(5)
    patterns = {}
    for _ in range(2000):
        good = chance.random() < 0.8
        vote = tuple(
            0 if chance.random() < 0.4 else (1 if (chance.random() < 0.85) == good else -1) for _ in range(3)
        )
        patterns[vote] = patterns.get(vote, 0) + 1
    df = spark.createDataFrame([(*p, n) for p, n in patterns.items()], "v_a int, v_b int, v_c int, n long")
    model = rules.fit(df, ["a", "b", "c"], max_steps=6, tolerance=0)
    share, post = plain_fit(patterns, 6)
    assert abs(model.good - share) < 1e-9
    for r in df.withColumn("p", model.posterior()).collect():
        assert abs(r.p - post[(r.v_a, r.v_b, r.v_c)]) < 1e-9
    fitted = rules.fit(df, ["a", "b", "c"], max_steps=300, tolerance=1e-7)
    assert fitted.converged and all(0.7 < a < 0.95 for a in fitted.accuracy().values())


def test_junk_goes_and_prose_stays(spark):
    chance = random.Random(1)
    rows = []
    for i in range(300):
        w = [chance.choice(rules.FUNCTION_WORDS) if chance.random() < 0.3 else x + "ing" for x in words(i, 80, 5000)]
        rows.append((i, ". ".join(" ".join(w[k : k + 8]).capitalize() for k in range(0, 80, 8)) + "."))
    for i in range(300, 330):
        rows.append((i, " ".join(x + "%%%" for x in words(i, 80, 5000))))
    for i in range(330, 360):
        rows.append((i, " ".join(x.upper() + "!!" for x in words(i, 80, 5000))))
    got = {r.doc_id: r.kept for r in rules.judge(documents(spark, rows)).collect()}
    assert all(got[i] for i in range(300)) and not any(got[i] for i in range(300, 360))


def test_edges(spark):
    rows = edge_rows()
    got = rules.judge(documents(spark, rows, clashing=True)).select("doc_id", "n_words", "base_failed", "kept")
    assert got.count() == len(rows)
    assert all(r.base_failed and not r.kept for r in got.collect() if r.n_words < 50)
    assert rules.judge(empty(spark)).count() == 0
