import random

import numpy as np
import pytest

from docsignal.llm import jaccard
from docsignal.llm.components import components
from helpers import LOWER, WORD, documents, edge_rows, empty, words


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def plain(rows):
    """[(key, n, component)] by comparing all pairs; a missing key counts as the smallest."""
    sets = [shingles(t) for _, t in rows]
    order = [(k is not None, k or 0) for k, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                if a != b:
                    parent[max(a, b, key=lambda x: order[x])] = min(a, b, key=lambda x: order[x])
    return sorted(((rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows))), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def corpus(seed, families=6):
    """Families of copies edited step by step, a passage in most texts, short texts, random ones."""
    chance = random.Random(seed)
    passage = words(99, 60, 5000)
    rows, key = [], 0
    for f in range(families):
        base = words(seed * 100 + f, chance.choice([8, 30, 80, 200]), 3000)
        for _ in range(chance.randrange(2, 14)):
            w = list(base)
            for _ in range(chance.randrange(0, 1 + len(w) // 25)):
                w[chance.randrange(len(w))] = f"x{chance.randrange(10**6)}"
            if chance.random() < 0.3:
                base = w  # a chain: later copies differ from early ones
            rows.append((key, " ".join(w)))
            key += 1
    for _ in range(25):
        rows.append((key, " ".join(words(key, chance.randrange(5, 60), 5000) + passage)))
        key += 1
    for n in (1, 2, 4, 5, 6):
        rows += [(key + i, " ".join(words(n, n))) for i in range(3)]
        key += 3
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    assert got(jaccard.similarity_components(documents(spark, rows))) == plain(rows)


def test_blocks_and_dealt_members(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "MEMBERS", 2)
    rows = corpus(4, families=4)
    assert got(jaccard.similarity_components(documents(spark, rows))) == plain(rows)


def test_a_poor_order_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "sketch_of", lambda s: np.zeros(1 << 20, np.uint32))
    rows = corpus(5)
    assert got(jaccard.similarity_components(documents(spark, rows))) == plain(rows)


def test_signatures_bound_the_overlap():
    chance = np.random.default_rng(2)
    for _ in range(300):
        n = int(chance.integers(1, 400))
        pool = np.unique(jaccard.mix(chance.integers(0, 2**62, 2 * n).astype(np.uint64)))
        a = np.sort(chance.choice(pool, min(n, len(pool)), replace=False))
        b = np.sort(chance.choice(pool, int(chance.integers(1, len(pool) + 1)), replace=False))
        x, y = jaccard.signature(a)[None], jaccard.signature(b)[None]
        to = min(x.shape[1], y.shape[1])
        bits = np.bitwise_count(jaccard.fold(x, to) ^ jaccard.fold(y, to)).sum()
        common = len(np.intersect1d(a, b))
        assert bits <= len(a) + len(b) - 2 * common
        if jaccard.links(len(a), len(b), common):
            assert jaccard.may_link(np.array([len(a)]), np.array([len(b)]), np.array([bits]))[0]


def test_edges(spark):
    rows = edge_rows()
    expected = plain([r[:2] for r in rows])
    assert got(jaccard.similarity_components(documents(spark, rows, clashing=True))) == expected
    assert got(jaccard.similarity_components(empty(spark))) == []


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    edges += [(200, 200), (202, 201), (201, 202), (203, 201)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    of = {r.node: r.component for r in found.collect()}
    assert {of[i] for i in range(61)} == {0} and {of[i] for i in range(100, 160)} == {100}
    assert {of[i] for i in (201, 202, 203)} == {201} and 200 not in of


def test_rows_of_one_key_with_other_texts(spark):
    """A text just under the limit shares its key with a near copy of the same head."""
    rows = []
    for n in range(12):
        base = words(1000 + n, 104, 10**6)
        under = base[:92] + words(2000 + n, 12, 10**6)
        near = base[:100] + words(3000 + n, 4, 10**6)
        rows += [(10 * n, " ".join(base)), (10 * n + 1, " ".join(under)), (10 * n + 1, " ".join(near))]
    assert got(jaccard.similarity_components(documents(spark, rows))) == plain(rows)
