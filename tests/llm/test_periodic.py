import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import WORD, documents, edge_rows, empty, words

from docsignal.llm import periodic
from docsignal.llm.queries import op11_periodic_runs


def plain_runs(w):
    """Runs by definition: every stretch of every period, smallest period first."""
    seen, out = set(), []
    ids = np.unique(w, return_inverse=True)[1] if len(w) else np.zeros(0)
    for q in range(1, len(w) // 3 + 1):
        equal = np.concatenate([[False], ids[:-q] == ids[q:], [False]]).astype(int)
        edges = np.flatnonzero(np.diff(equal))
        for start, end in zip(edges[::2].tolist(), (edges[1::2] + q).tolist()):
            if end - start >= max(24, 3 * q) and (start, end) not in seen:
                seen.add((start, end))
                out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_line(doc_id, text, rewrite=True):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if rewrite and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    s, m, q = best or (None, None, None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), s, m, q, m and 1000 * m // q, sha(listed), sha(kept), n)


def compare(spark, df, rows):
    got = sorted((tuple(r) for r in periodic.digests(periodic.find_runs(df)).collect()), key=repr)
    assert got == sorted((plain_line(k, t, False) for k, t in rows), key=repr)


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_periodic_words(seed):
    chance = random.Random(seed)
    texts = []
    for _ in range(30):
        w = []
        for _ in range(chance.randrange(6)):
            block = [chance.choice("ab" if chance.random() < 0.7 else "abcdef") for _ in range(chance.randrange(1, 14))]
            w += block * chance.randrange(1, 12) + block[: chance.randrange(len(block))]
            w += [chance.choice("abcxyz") for _ in range(chance.randrange(4))]
        texts.append([x.encode() for x in w])
    found = periodic.runs_of(texts)
    assert {i: r for i, t in enumerate(texts) if (r := plain_runs(t))} == found


@pytest.mark.parametrize("length", [0, 1, 23, 24, 25, 71, 400])
def test_one_word_again_and_again(length):
    runs = periodic.runs_of([[b"x"] * length]).get(0, [])
    assert runs == ([(0, length, 1)] if length >= 24 else [])


def test_runs_end_with_their_document():
    texts = [[b"a", b"b"] * 8, [b"a", b"b"] * 8, [b"a", b"b"] * 12]
    assert periodic.runs_of(texts) == {2: [(0, 24, 2)]}


def test_prefix_ranks_are_the_suffix_order():
    w = np.array(random.Random(5).choices(range(3), k=300))
    rank = periodic.prefix_ranks(w)[-1][:-1]
    assert sorted(range(300), key=lambda i: w[i:].tolist()) == np.argsort(rank).tolist()


def test_square_parts_in_small_portions(monkeypatch):
    w = np.array(random.Random(6).choices(range(2), k=600) + [0, 1, 1] * 40)
    whole = [x.tolist() for x in periodic.word_runs(w)]
    monkeypatch.setattr(periodic, "PORTION", 3)
    assert [x.tolist() for x in periodic.word_runs(w)] == whole


def test_edges_and_clashing_columns(spark):
    rows = [(r[0], r[1]) for r in edge_rows()] + [
        (20, "no no " * 40), (20, "no no " * 40), (21, "é x y\x0bz " * 30), (22, "\x00 " * 50),
    ]
    compare(spark, documents(spark, rows), rows)
    compare(spark, documents(spark, rows, clashing=True), rows)
    assert periodic.find_runs(empty(spark)).count() == 0
    assert periodic.planted(empty(spark)).count() == 0


def test_long_text(spark):
    w = words(3, 40_000, 900)
    w[20_000:] = (w[20_000:20_700] * 30)[:20_000]
    text = " ".join(w)
    line = periodic.find_runs(documents(spark, [(1, text)])).first()
    assert [tuple(r) for r in line.runs] == [(20_000, 20_000, 700)]
    assert line.collapsed == " ".join(w[:20_700])


def test_query_equals_the_plain_version(spark, tmp_path):
    chance = random.Random(1)
    rows = [(i, " ".join(words(i, chance.randrange(0, 120), 30))) for i in range(400)]
    rows += [(None, "a b"), (1000, None), (1001, ""), (1002, "one " * 30)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    want = sorted((plain_line(k, t) for k, t in rows), key=repr)
    assert got == want
    assert sum(r[1] for r in want) > 5
