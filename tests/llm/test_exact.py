import hashlib
import random

import pytest

from docsignal.llm import exact
from helpers import LOWER, bag, documents, edge_rows, empty


def plain(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(key)
    out = []
    for text, keys in groups.items():
        keys.sort(key=lambda k: (k is not None, k or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        for i, key in enumerate(keys):
            out.append((key, keys[-1], len(keys), i == len(keys) - 1, digest))
    return sorted(out, key=repr)


def corpus():
    chance = random.Random(1)
    rows = [(i, chance.choice(["Alpha", "alpha", "beta", "Éa", "éA", "", None])) for i in range(200)]
    return rows + [(1000 + i, f"text {i % 150}") for i in range(300)]


@pytest.mark.parametrize("digits", [64, 1])
def test_groups_equal_a_plain_grouping(spark, digits):
    """With one hex digit most state keys cover different texts, which the byte check must see."""
    rows = corpus()
    found = exact.deduplicate(documents(spark, rows), hex_digits=digits, state_partitions=2)
    assert bag(found) == plain(rows)


def test_state_carries_over_batches(spark):
    rows = corpus()
    df = documents(spark, rows).repartition(6)
    found = exact.deduplicate(df, files_per_batch=1, state_partitions=2)
    assert bag(found) == plain(rows)


def test_edges(spark):
    rows = edge_rows()
    found = exact.deduplicate(documents(spark, rows, clashing=True), state_partitions=2)
    assert bag(found) == plain([r[:2] for r in rows])
    assert bag(exact.deduplicate(empty(spark))) == []


def test_unique_rows_keep_their_columns(spark):
    rows = edge_rows()
    df = documents(spark, rows)
    found = exact.unique_rows(df, ["doc_id", "text", "lang"])
    stay = [r[0] for r in plain([r[:2] for r in rows]) if r[3]]
    assert sorted((r.doc_id for r in found.collect()), key=repr) == sorted(stay, key=repr)
    assert set(bag(found)) <= {r[:3] for r in rows}


def test_settings_are_put_back(spark):
    before = {k: spark.conf.get(k, None) for k in exact.STATE}
    exact.deduplicate(documents(spark, [(1, "a"), (2, "a")]), state_partitions=1).count()
    assert before == {k: spark.conf.get(k, None) for k in exact.STATE}
