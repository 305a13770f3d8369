import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import LOWER, documents, edge_rows, empty, words
from pyspark.sql import functions as F

from docsignal.llm import search
from docsignal.llm.common import PrefixHash

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, items, k=10):
    """Every document scored for every item."""
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    n = sum(1 for _, t in terms if t)
    total = sum(len(t) for _, t in terms)
    df = Counter(x for _, t in terms for x in set(t))
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, asked in queries.items():
        scored = []
        for key, t in terms:
            tf = Counter(t)
            m = 10 + (90 * len(t) * n) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1)))
                * ((10**9 * tf[x]) // (1000 * tf[x] + 8 * m))
                for x in asked
                if tf[x]
            )
            if score > 0:
                scored.append((-score, key is not None, key or 0))
        for rank, (score, known, key) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, key if known else None, -score))
    return sorted(out, key=repr)


def found(spark, docs, items, clashing=False, **options):
    df = documents(spark, docs, clashing)
    queries = spark.createDataFrame(items, "item_id long, text string")
    if clashing:
        queries = queries.withColumns({c: F.lit(None).cast("double") for c in ("rank", "doc_id", "score")})
    got = search.search(search.index_documents(df), queries, **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def corpus(seed, n=300):
    chance = random.Random(seed)
    docs = [(i, " ".join(words(seed * 1000 + i, chance.randrange(0, 60), 120))) for i in range(n)]
    docs += [(n + i, docs[i // 2][1]) for i in range(60)]
    docs += [(10_000, "w3 " * 700 + "w4"), (10_001, " ".join(words(seed, 5000, 3000)))]
    items = [(i, " ".join(words(-i - 1, chance.randrange(0, 12), 140))) for i in range(25)]
    return docs, items + [(3, "w1 W2; w3"), (50, None), (None, "w7_w8")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_scoring_everything(spark, seed):
    docs, items = corpus(seed)
    assert found(spark, docs, items) == plain(docs, items)


def test_many_blocks_of_queries(spark, monkeypatch):
    docs, items = corpus(3)
    monkeypatch.setattr(search, "BLOCK_BYTES", 200)
    assert found(spark, docs, items, k=4) == plain(docs, items, 4)


def test_sketches_hold_the_largest_frequencies():
    docs, _ = corpus(4, 2000)
    texts = [t.encode() for _, t in docs]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    counts, sketch = search.sketches(data, offsets, PrefixHash())
    hasher = PrefixHash()
    assert counts.tolist() == [len(search.terms_of(t)) for t in texts]
    for row in range(0, len(texts), 17):
        for term, tf in Counter(search.terms_of(texts[row])).items():
            at = search.coordinate(np.array([search.term_hash(hasher, term)], np.uint64))[0]
            assert sketch[row, at] >= min(tf, search.FULL)


def test_edges_ties_and_clashing_columns(spark):
    docs = [(r[0], r[1]) for r in edge_rows()]
    docs += [(30 + i % 15, "the very same sentence") for i in range(40)] + [(None, "no key here")]
    items = [(1, "the very same sentence"), (2, "漢字 é"), (2, "KEY"), (3, ""), (None, "w1 w2"), (4, "...")]
    assert found(spark, docs, items, clashing=True) == plain(docs, items)
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None), (2, "--")], items) == []
    queries = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.search(search.index_documents(empty(spark)), queries).count() == 0


def test_a_document_is_read_once_and_scored_for_all_queries_together(monkeypatch):
    """Before, every pair of document and query took a loop over the query's terms, and every block of
    queries read the documents of a portion again."""
    docs, items = corpus(5, 40)
    block = search.query_block([(search.NULL_KEY if i is None else i, t) for i, t in items])
    number = {t: n for n, t in enumerate(block.vocabulary)}
    texts = [(t or "").encode() for _, t in docs]
    terms = [search.terms_of(t) for t in texts]
    n, total = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(x for t in terms for x in set(t))
    weights = np.array([search.weight(df[t], n) for t in block.vocabulary], np.int64)
    m = np.array([search.length_share(len(t), n, total) for t in terms], object)
    read, scored = [], []
    monkeypatch.setattr(search, "terms_of", lambda t, plain=search.terms_of: read.append(t) or plain(t))
    monkeypatch.setattr(search, "impact", lambda *a, plain=search.impact: scored.append(a) or plain(*a))
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    keys = np.array([k for k, _ in docs])
    portion = search._Portion(keys, np.frombuffer(b"".join(texts), np.uint8), offsets, m, number)
    best = [search._Best(10) for _ in block.keys]
    for part in (slice(0, 9), slice(9, None)):  # more than one block of queries
        bounds = np.full((len(docs), len(best[part])), 1e12)
        portion.rank(bounds, search._Asked(block.terms[part], weights), best[part])
    assert len(read) == len(scored) == len(docs)
    got = []
    for key, top in zip(block.keys, best):
        for rank, (score, minus) in enumerate(sorted(top.heap, reverse=True), 1):
            got.append((None if key == search.NULL_KEY else key, rank, -minus, score))
    assert sorted(got, key=repr) == plain(docs, items)
