import hashlib
import random
import statistics
import struct

import pytest
import xxhash
from helpers import LOWER, WORD, documents, edge_rows, empty, words
from pyspark.sql import functions as F

from docsignal.llm import fingerprints
from docsignal.llm.queries import op12_fingerprints


def chain(*values):
    """The 64-bit hash of several columns: each one's is the seed of the next."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<q" if isinstance(v, int) else "<i", v)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def with_int(v, t):
    """The 64-bit hash of a long and an int, which is hashed as 4 bytes."""
    seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=42)
    seed = xxhash.xxh64_intdigest(struct.pack("<i", t), seed=seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def murmur(*values):
    """The 32-bit hash of ints, each one's the seed of the next."""
    m, h = 0xFFFFFFFF, 42
    rot = lambda x, r: ((x << r) | (x >> (32 - r))) & m
    for v in values:
        k = rot((v * 0xCC9E2D51) & m, 15) * 0x1B873593 & m
        h = (rot(h ^ k, 13) * 5 + 0xE6546B64) & m
        h ^= 4
        h = ((h ^ (h >> 16)) * 0x85EBCA6B) & m
        h = ((h ^ (h >> 13)) * 0xC2B2AE35) & m
        h ^= h >> 16
    return h


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain_bits(text, bins_log, bits):
    """The low bits of every bin, by the definition, one bin after the other."""
    bins, shift = 1 << bins_log, 64 - bins_log
    least = {}
    for s in shingles(text):
        h = chain(*(chain(x) for x in s))
        b = h >> shift
        least[b] = min(least.get(b, h), h)
    if not least:
        return None
    out = []
    for i in range(bins):
        b = i - bins // 2
        if b not in least:
            asked = (murmur(i, t) % bins - bins // 2 for t in range(fingerprints.PROBES))
            b = next((j for j in asked if j in least), None)
            if b is None:
                b = min(least, key=lambda j: with_int(j, i))
        out.append(with_int(least[b], i) & ((1 << bits) - 1))
    return out


def plain_hex(text, bins_log=fingerprints.BINS_LOG, bits=fingerprints.BITS):
    low = plain_bits(text, bins_log, bits)
    if low is None:
        return ""
    return f"{int(''.join(format(x, f'0{bits}b') for x in low), 2):0{(bits << bins_log) // 4}X}"


def plain_likeness(a, b, bins_log=fingerprints.BINS_LOG, bits=fingerprints.BITS):
    a, b = plain_bits(a, bins_log, bits), plain_bits(b, bins_log, bits)
    if a is None or b is None:
        return float(a is b)
    share = sum(x == y for x, y in zip(a, b)) / len(a)
    return max(0.0, (share - 2**-bits) / (1 - 2**-bits))


def rows_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i long, t string")


TEXTS = [None, "", " \t\n", "one", "One", "two words", "a b c d", "a b c d e", " ".join(words(1, 40)),
         " ".join(words(2, 700)), "É é 漢 字 😀 x\x0by", " ".join(words(3, 9000, 4000)), "\x00 a"]


@pytest.mark.parametrize("bins_log, bits", [(8, 4), (6, 1), (7, 2), (9, 8)])
def test_fingerprints_equal_the_plain_ones(spark, bins_log, bits):
    df = fingerprints.with_fingerprint(rows_of(spark, TEXTS), "t", "fp", bins_log, bits)
    got = {r.i: r.x for r in df.select("i", fingerprints.hexadecimal("fp").alias("x")).collect()}
    assert got == {i: plain_hex(t, bins_log, bits) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_likeness_equals_the_plain_one_and_is_near_the_truth(spark, bits):
    chance = random.Random(bits)
    pairs = []
    for n in (6, 30, 200, 3000):
        for share in (0.0, 0.3, 0.7, 0.95, 1.0):
            w = words(chance.random(), n, 10**6)
            cut = int(n * share)
            pairs.append((" ".join(w), " ".join(w[:cut] + words(chance.random(), n - cut, 10**6))))
    pairs += [("", None), ("", "a"), ("a", "b"), ("a", "A")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    df = fingerprints.with_fingerprint(df, "a", "x", 9, bits)
    df = fingerprints.with_fingerprint(df, "b", "y", 9, bits)
    got = {r.i: r.s for r in df.select("i", fingerprints.likeness("x", "y", bits).alias("s")).collect()}
    wrong = []
    for i, (a, b) in enumerate(pairs):
        assert got[i] == pytest.approx(plain_likeness(a, b, 9, bits), abs=1e-12)
        truth = len(shingles(a) & shingles(b)) / max(1, len(shingles(a) | shingles(b)))
        if shingles(a) and shingles(b):
            wrong.append(got[i] - truth)
    assert max(map(abs, wrong)) < (0.2 if bits == 1 else 0.12)
    assert abs(statistics.mean(wrong)) < 0.03


def plain_query(rows):
    keyed = sorted({k for k, _ in rows}, key=lambda k: (k is not None, k or 0), reverse=True)
    after = dict(zip(keyed, keyed[1:] + keyed[:1]))
    first = {
        k: min((t or "" for j, t in rows if j == k), key=lambda t: (chain(t), len(t))) for k in keyed
    }
    out = []
    for k, t in rows:
        t = t or ""
        c = len(t) // 3
        edited = t[: len(t) - c] + first[after[k]][:c]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        near = plain_likeness(t, edited), plain_likeness(t, first[after[k]])
        out.append((k, len(t), sha, plain_hex(t), plain_hex(edited), *(round(x, 9) for x in near)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("clashing", [False, True])
def test_query_equals_the_plain_version(spark, tmp_path, clashing):
    chance = random.Random(3)
    rows = [(r[0], r[1] and r[1][:4000]) for r in edge_rows()]
    rows += [(100 + i, " ".join(words(i // 2, chance.randrange(1, 90), 60))) for i in range(40)]
    rows += [(5, "another text under a key that is there"), (120, None)]
    documents(spark, rows, clashing).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = op12_fingerprints(spark, str(tmp_path))
    found = found.withColumns({c: F.round(c, 9) for c in ("near_edited", "near_next")})
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_query(rows)


def test_empty_table_and_a_single_document(spark):
    assert fingerprints.compare_edited(empty(spark)).count() == 0
    line = fingerprints.compare_edited(documents(spark, [(3, "one two three")])).first()
    assert (line.doc_id, line.n_chars, line.near_next) == (3, 13, 1.0)
    assert line.edited_sha256 == hashlib.sha256(b"one two tone ").hexdigest()


def test_no_python_in_the_plan(spark):
    df = fingerprints.compare_edited(documents(spark, [(1, "a b"), (2, "c")]))
    assert "Python" not in df._jdf.queryExecution().toString()
