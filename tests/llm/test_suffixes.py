import random

import numpy as np
import pytest

from docsignal.llm import common, suffixes
from docsignal.llm.common import PrefixHash
from helpers import bag, documents, edge_rows, empty, words


def plain(rows, length):
    """[(key, n_bytes, spans, kept)] by a table of all strings of ``length`` bytes."""
    first = {}
    texts = [((k is not None, k or 0), k, (t or "").encode()) for k, t in rows]
    for order, _, data in texts:
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            first[w] = min(first.get(w, order), order)
    out = []
    for order, key, data in texts:
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < order:
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        spans = [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((key, len(data), spans, kept))
    return sorted(out, key=repr)


def got(df):
    return sorted(
        ((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr
    )


def corpus(seed):
    chance = random.Random(seed)
    passages = [" ".join(words(seed * 10 + i, chance.randrange(4, 40), 50)) for i in range(6)]
    rows = []
    for key in chance.sample(range(1000), 60):
        parts = []
        for _ in range(chance.randrange(0, 6)):
            part = chance.choice(passages) if chance.random() < 0.5 else " ".join(words(chance.random(), 8, 40))
            a = chance.randrange(0, 10)
            parts.append(part[a:])
        rows.append((key, chance.choice(["", " ", "é"]).join(parts)))
    return rows + [(2000 + i, rows[i][1]) for i in range(8)]


@pytest.mark.parametrize("length,gram", [(12, 4), (20, 20), (50, 16), (7, 1)])
def test_spans_equal_a_table_of_all_strings(spark, length, gram):
    rows = corpus(length)
    assert got(suffixes.remove_repeats(documents(spark, rows), length, gram)) == plain(rows, length)


@pytest.mark.parametrize("limit,chunk", [(1, 3), (3, 10), (1, 50_000), (5, 1)])
def test_hot_grams_and_small_chunks(spark, monkeypatch, limit, chunk):
    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    rows = corpus(limit * 100 + chunk)
    found = suffixes.remove_repeats(documents(spark, rows).coalesce(1), 15, 4, limit=limit)
    assert got(found) == plain(rows, 15)


def test_a_hot_gram_of_equal_blocks_keeps_a_small_buffer(monkeypatch):
    """Many copies of one block arrive in many batches; what waits stays small, all are covered."""
    sizes, count = [], 200_000
    folded = suffixes._folded
    monkeypatch.setattr(suffixes, "CHUNK", 1000)
    monkeypatch.setattr(suffixes, "_folded", lambda b: sizes.append(b.num_rows) or folded(b))
    captured = {}
    monkeypatch.setattr(suffixes, "map_batches", lambda df, run, schema: captured.setdefault("run", run))

    class Rows:
        def repartition(self, *_):
            return self

        sortWithinPartitions = repartition

    suffixes.bucket_spans(Rows(), 5)
    import pyarrow as pa

    ids = np.random.default_rng(1).permutation(count)
    batches = (
        pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(2000, np.int32)), pa.array(ids[i : i + 2000]), pa.array(np.zeros(2000, np.int64)),
             pa.array(np.zeros(2000, np.int64)), pa.array(np.full(2000, 6, np.int32)),
             pa.array([b"abcdef", b"bcdefg"] * 1000)],
            names=suffixes.BLOCK_NAMES,
        )
        for i in range(0, count, 2000)
    )
    spans = [(d, a, b) for out in captured["run"](batches) for d, a, b in zip(*(out.column(k).to_pylist() for k in (0, 2, 3)))]
    assert max(sizes) < 5000 and len(sizes) >= 90
    whole = {d for d, a, b in spans if (a, b) == (0, 6)}
    left = [ids[0::2].min(), ids[1::2].min()]
    assert whole == set(range(count)) - set(left)


def test_rows_of_one_key_with_other_texts(spark):
    passage = " ".join(words(5, 20, 10**6))
    rows = [(1, passage)] + [(7, f"{i} {passage} {i}") for i in range(5)] + [(7, "nothing of it " * 9), (8, passage)]
    rows += [(7, rows[1][1]), (7, None), (7, "x" + rows[6][1])]
    assert got(suffixes.remove_repeats(documents(spark, rows))) == plain(rows, 50)


def test_few_letters(spark):
    chance = random.Random(6)
    rows = [(i, "".join(chance.choice("ab") for _ in range(chance.randrange(0, 200)))) for i in range(30)]
    rows += [(100, "a" * 500), (101, "a" * 500), (102, "ab" * 200)]
    assert got(suffixes.remove_repeats(documents(spark, rows), 10, 4)) == plain(rows, 10)


def sorted_windows(data, group, length):
    start = np.arange(len(data) - length + 1)
    found = suffixes.Suffixes(data, start, group[: len(start)], length)
    return found, found.runs()


def test_merge_sort_orders_suffixes():
    rng = np.random.default_rng(3)
    for length in (1, 5, 9, 30):
        data = rng.integers(97, 99, 400).astype(np.uint8)
        group = np.sort(rng.integers(0, 5, 400))
        found, (order, number) = sorted_windows(data, group, length)
        text = [(int(group[i]), data[i : i + length].tobytes()) for i in order]
        assert text == sorted(text)
        assert [a == b for a, b in zip(text, text[1:])] == list(number[1:] == number[:-1])


def test_hash_collisions_are_seen(monkeypatch):
    monkeypatch.setattr(PrefixHash, "span", lambda self, sums, a, b: np.zeros(len(a), np.uint64))
    data = np.random.default_rng(3).integers(97, 99, 300).astype(np.uint8)
    _, (order, number) = sorted_windows(data, np.zeros(300, int), 12)
    text = [data[i : i + 12].tobytes() for i in order]
    assert [a == b for a, b in zip(text, text[1:])] == list(number[1:] == number[:-1])
    assert len(set(text)) == number[-1] + 1


def test_edges(spark):
    rows = edge_rows()
    found = suffixes.remove_repeats(documents(spark, rows, clashing=True))
    assert got(found) == plain([r[:2] for r in rows], 50)
    assert bag(suffixes.remove_repeats(empty(spark))) == []


def test_text_and_other_columns(spark):
    rows = [(1, "é" * 60, "x"), (2, "a" + "é" * 60 + "b", "y"), (3, "ü" + "é" * 60 + "ü", "z")]
    found = suffixes.remove_repeats(documents(spark, rows), as_text=True, carry=["lang", "source"])
    by = {r.doc_id: r for r in found.collect()}
    assert (by[1].kept, by[1].lang) == ("é" * 60, "x")
    assert (by[2].kept, by[2].lang, by[2].source) == ("ab", "y", "src")
    assert by[3].kept == "ü"  # its second one lost the byte it shares with é


def test_passes_leave_no_shuffle_files(spark):
    """Before, the grams and blocks that were shuffled lay on disk until the result was read."""
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: sum(str(f).endswith(".data") for f in blocks.getAllFiles().mkString("\n").split("\n"))
    rows = corpus(3)
    before = files()
    spans = suffixes.repeated_spans(documents(spark, rows).selectExpr("doc_id", "doc_id tag", "text"))
    assert files() <= before
    assert spans.count()


@pytest.mark.parametrize("length", [5, 8, 50])
def test_suffixes_are_sorted_in_few_rounds(monkeypatch, length):
    """Before, every doubling of runs searched for each suffix by hashes: 14 rounds for these."""
    rounds, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: rounds.append(len(keys[0])) or lexsort(keys))
    data = np.tile(np.random.default_rng(2).integers(97, 123, 1000).astype(np.uint8), 12)
    start = np.arange(len(data) - length + 1)
    order, number = suffixes.Suffixes(data, start, np.zeros(len(start), int), length).runs()
    assert 1 <= len(rounds) <= -(-length // 8)
    text = [data[i : i + length].tobytes() for i in order]
    assert text == sorted(text) and len(set(text)) == number[-1] + 1
    assert all(a < b for a, b, t, u in zip(order, order[1:], text, text[1:]) if t == u)


def test_the_bitmap_grows_with_the_grams(spark):
    assert [suffixes.bitmap_bits(n) for n in (0, 10**7, 3 * 10**7, 6 * 10**7, 10**10)] == [27, 27, 28, 29, 29]
    keys = np.random.default_rng(4).integers(-(1 << 63), (1 << 63) - 1, 3000)
    bitmap = common.key_bitmap(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key", 14)
    low = keys.astype(np.uint64) & np.uint64((1 << 14) - 1)
    assert np.unpackbits(bitmap.view(np.uint8)).sum() == len(np.unique(low))
    assert common.maybe_in(bitmap, keys).all()
