import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docsignal.llm import packing
from docsignal.llm.queries import op8_packing
from helpers import documents, edge_rows, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def exact():
    found = Tokenizer.from_file(PATH)
    return lambda text: found.encode(text, add_special_tokens=False).ids


def check(rows, docs, exact, capacity):
    """Every id in one piece, sequences gapless and not too long; returns the padding."""
    sequences, texts = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    wanted = {}
    for key, text in docs:
        wanted.setdefault(key, []).append([*exact(text or ""), packing.END_ID])
    for key, lists in wanted.items():
        found = sorted(texts[key], key=lambda p: p[0])
        assert sum(len(p[1]) for p in found) == sum(map(len, lists))
        if len(lists) == 1:
            assert [i for p in found for i in p[1]] == lists[0]
            assert [p[0] for p in found] == list(np.cumsum([0] + [len(p[1]) for p in found[:-1]]))
            assert {p[2] for p in found} == {len(lists[0])}
    return padding


@pytest.mark.parametrize("capacity", [8, 64, 2048])
def test_packs_everything_with_little_padding(spark, exact, capacity):
    chance = random.Random(capacity)
    docs = [(i, " ".join(chance.choice("alpha beta gamma, 12 é\n漢 <|endoftext|>".split(" ")) for _ in range(chance.randrange(0, 150)))) for i in range(300)]
    rows = packing.pack(documents(spark, docs), PATH, capacity, buffer_pieces=64).collect()
    padding = check(rows, docs, exact, capacity)
    total = sum(r.length for r in rows)
    assert padding <= 0.02 * total


def test_both_tokenizer_libraries_agree(exact):
    texts = ["", " ", "a  b   c\n\n d", "don't we'll \t x", "<|endoftext|> x", "漢字é😀 123 ...", "\x00  y"]
    assert packing.tokenizer(PATH)(texts) == [exact(t) for t in texts]


def test_fill_is_closest(spark):
    chance = random.Random(8)
    for _ in range(300):
        capacity = chance.randrange(5, 40)
        lengths = [chance.randrange(1, capacity + 1) for _ in range(chance.randrange(1, 9))]
        counts = {n: lengths.count(n) for n in lengths}
        chosen = packing.fill(counts, capacity)
        assert all(0 < n <= counts[k] for k, n in chosen.items()) and max(lengths) in chosen
        rest = list(lengths)
        rest.remove(max(lengths))
        best = max(
            max(lengths) + sum(c)
            for k in range(len(rest) + 1)
            for c in itertools.combinations(rest, k)
            if max(lengths) + sum(c) <= capacity
        )
        assert sum(k * n for k, n in chosen.items()) == best


def test_power_cuts():
    for total in range(0, 600):
        sizes = packing.power_cuts(total, 64)
        assert sum(sizes) == total and all(s & (s - 1) == 0 and 0 < s <= 64 for s in sizes)


def test_edges(spark, exact):
    rows = edge_rows()
    found = packing.pack(documents(spark, rows, clashing=True), PATH).collect()
    check(found, [r[:2] for r in rows], exact, packing.CAPACITY)
    assert packing.pack(empty(spark), PATH).count() == 0


def test_query_digests(spark):
    import zlib

    found = op8_packing(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = packing.pack(docs, PATH).collect()
    want = {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in whole}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in found.collect()} == want
