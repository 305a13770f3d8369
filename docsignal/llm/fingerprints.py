"""Document fingerprints: one-permutation MinHash, optimally densified, stored as packed low bits.

All steps are DataFrame expressions, evaluated row by row in the JVM; no array leaves its row.

* Shingles are five words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased); fewer words make one shingle.
  Each is hashed once, to 64 bits.  The top bits name a bin, the rest is its value there.
* One sort of the hashes, with one end mark a bin added, puts the least value of every bin first.
* An empty bin takes the value of another one.  It asks bins in an order of its own, the same for all
  documents: ``PROBES`` drawn bins first, then all others by a hash of both bins.  So it ends at a bin
  that is a uniform choice among the filled ones and that a similar document makes as well.
* Value and bin are hashed together and ``bits`` low bits are kept, packed into longs.  Bits of
  different values agree by chance in one of 2 ** bits bins; ``likeness`` takes that share out again.

Equal texts have equal fingerprints.  NULL and empty texts and texts without words have no shingles
and the empty fingerprint: its likeness to itself is 1, to every other 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docsignal.llm.common import LOWER, UPPER, key_back, key_column, materialize

SHINGLE = 5
BINS_LOG, BITS = 8, 4
PROBES = 32
WORD_BREAK = "[\\x20\\x09-\\x0D]+"


def _shingles(words: str) -> Column:
    """64-bit hashes of the shingles, from the hashes of the words."""
    many = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.lit(0), F.size(words) - (SHINGLE - 1))),
        lambda w, i: F.xxhash64(w, *(F.get(words, i + s) for s in range(1, SHINGLE))),
    )
    few = F.when(F.size(words) > 0, F.array(F.xxhash64(words)))
    return F.when(F.size(words) >= SHINGLE, many).otherwise(few)


def _by_bin(hashes: str, bins_log: int) -> Column:
    """The hashes and an end mark for every bin, sorted: bins in the order of signed top bits."""
    half, shift = 1 << (bins_log - 1), 64 - bins_log
    numbers = F.sequence(F.lit(-half).cast("long"), F.lit(half - 1).cast("long"))
    ends = F.transform(numbers, lambda b: F.shiftleft(b, shift).bitwiseOR(F.lit((1 << shift) - 1)))
    return F.sort_array(F.concat(F.col(hashes), ends))


def _least(by_bin: str, bins_log: int) -> Column:
    """For every bin the hash after the end mark before, or NULL if that is an end mark too."""
    low = F.lit((1 << (64 - bins_log)) - 1)
    first = F.filter(by_bin, lambda h, i: (i == 0) | (F.get(by_bin, i - 1).bitwiseAND(low) == low))
    return F.transform(first, lambda h: F.when(h.bitwiseAND(low) != low, h))


def _densified(least: str, filled: str, bins_log: int) -> Column:
    """Every empty bin takes the value of the first filled bin in its own order of bins."""
    bins, shift = 1 << bins_log, 64 - bins_log

    def value(h: Column, i: Column) -> Column:
        draws = [F.hash(i, F.lit(n)).bitwiseAND(F.lit(bins - 1)) for n in range(PROBES)]
        asked = [F.get(least, draw) for draw in draws]  # looked up one after the other
        ranked = F.transform(
            filled, lambda v: F.struct(F.xxhash64(F.shiftright(v, shift), i).alias("r"), v.alias("v"))
        )
        return F.coalesce(h, *asked, F.array_min(ranked)["v"])

    return F.transform(least, value)


def _low_bits(values: str, bits: int) -> Column:
    """``bits`` low bits of the hash of (value, bin)."""
    mask = F.lit((1 << bits) - 1).cast("long")
    return F.transform(values, lambda v, i: F.xxhash64(v, i).bitwiseAND(mask))


def _packed(low: str, bins_log: int, bits: int) -> Column:
    """The low bits of 64 / bits bins to a long."""
    each = 64 // bits
    return F.transform(
        F.sequence(F.lit(0), F.lit((1 << bins_log) // each - 1)),
        lambda n: F.aggregate(
            F.slice(low, n * each + 1, F.lit(each)),
            F.lit(0).cast("long"),
            lambda a, x: F.shiftleft(a, bits).bitwiseOR(x),
        ),
    )


def with_fingerprint(
    rows: DataFrame, text: str, name: str, bins_log: int = BINS_LOG, bits: int = BITS
) -> DataFrame:
    """``rows`` with the fingerprint of column ``text`` as array of longs ``name``.

    ``bits`` is 1, 2, 4 or 8; the 2 ** bins_log bins fill at least one long.  Steps stand in columns
    of their own (``name`` with a suffix, dropped at the end), so that no array is computed twice.
    """
    if bits not in (1, 2, 4, 8) or bits << bins_log < 64:
        raise ValueError("bits must be 1, 2, 4 or 8, and the bins must fill a long")
    steps = [f"{name}__{n}" for n in ("words", "shingles", "by_bin", "least", "filled", "dense", "low")]
    words, shingles, by_bin, least, filled, dense, low = steps
    lower = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), UPPER, LOWER)
    split = F.array_remove(F.split(lower, WORD_BREAK), "")
    rows = rows.withColumn(words, F.transform(split, lambda w: F.xxhash64(w)))
    rows = rows.withColumn(shingles, _shingles(words))
    rows = rows.withColumn(by_bin, _by_bin(shingles, bins_log))
    rows = rows.withColumn(least, _least(by_bin, bins_log))
    rows = rows.withColumn(filled, F.filter(least, lambda h: h.isNotNull()))
    rows = rows.withColumn(dense, _densified(least, filled, bins_log))
    rows = rows.withColumn(low, _low_bits(dense, bits))
    none = F.array().cast("array<bigint>")
    packed = F.when(F.col(low).isNull(), none).otherwise(_packed(low, bins_log, bits))
    return rows.withColumn(name, packed).drop(*steps)


def likeness(a: str, b: str, bits: int = BITS) -> Column:
    """Estimated similarity (0 to 1) of two packed fingerprints of the same shape.

    The share of equal bins, less the chance share 2 ** -bits: (share - c) / (1 - c), 0 at least.
    """
    ones = F.lit(sum(1 << i for i in range(0, 64, bits)) - (1 << 64 if bits == 1 else 0)).cast("long")

    def differing(x: Column, y: Column) -> Column:
        folded, step = x.bitwiseXOR(y), bits // 2
        while step:
            folded, step = folded.bitwiseOR(F.shiftrightunsigned(folded, step)), step // 2
        return F.bit_count(folded.bitwiseAND(ones))

    parts = F.zip_with(a, b, differing)
    differ = F.aggregate(parts, F.lit(0), lambda s, x: s + x)
    bins, chance = F.size(a) * (64 // bits), 2.0**-bits
    share = (bins - differ) / bins
    estimate = F.greatest(F.lit(0.0), (share - chance) / (1 - chance))
    both = (F.size(a) > 0) & (F.size(b) > 0)
    return F.when(both, estimate).otherwise((F.size(a) == F.size(b)).cast("double"))


def hexadecimal(packed: str) -> Column:
    """A fingerprint as text, 16 digits a long."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def next_rows(rows: DataFrame) -> DataFrame:
    """For every key of ``(k, h, n)`` the one before it: ``k, most, next_k, next_h, next_n``.

    ``most`` is the largest n of the key; (next_h, next_n) the smallest pair of the key before; the
    smallest key is followed by the largest.  Keys are sorted in ranges, each by itself; only one line
    a range reaches the driver, to tell it the first key of the next range.
    """
    spark = rows.sparkSession
    first = F.min(F.struct("h", "n"))
    keys = materialize(rows.groupBy("k").agg(F.max("n").alias("most"), first.alias("first")), "fingerprint-keys")
    ranges = keys.repartitionByRange(F.desc("k")).withColumn("range", F.spark_partition_id())
    ranges = materialize(ranges, "fingerprint-ranges")
    heads = ranges.groupBy("range").agg(F.max(F.struct("k", "first")).alias("head"))
    heads = sorted((r["range"], r["head"]["k"], tuple(r["head"]["first"])) for r in heads.collect())
    after = [(a[0], *b[1:]) for a, b in zip(heads, heads[1:] + heads[:1])]
    edges = spark.createDataFrame(after, "range int, head_k long, head struct<h: long, n: int>")
    order = Window.partitionBy("range").orderBy(F.desc("k"))
    placed = ranges.withColumn("follows", F.lead(F.struct("k", "first")).over(order))
    placed = placed.join(F.broadcast(edges), "range")
    next_k = F.coalesce(F.col("follows.k"), F.col("head_k"))
    following = F.coalesce(F.col("follows.first"), F.col("head"))
    placed = placed.select("k", "most", next_k.alias("next_k"), following.alias("next"))
    return placed.select(
        "k", "most", "next_k", F.col("next.h").alias("next_h"), F.col("next.n").alias("next_n")
    )


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text beside an edited one: its last third replaced by the start of the next document.

    The last n div 3 of n code points give way to the first as many (or all) of the document with the
    next smaller key; after the smallest comes the largest.  Returns ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``, fingerprints as arrays of longs.

    Of several rows with one key that with the smallest text hash (then length) is what other keys
    have as next; all of them have the same next document.  Equal rows give equal results.  A NULL key
    is the smallest.  A document alone is its own next.  Other columns are ignored.

    Texts are shuffled once, by key, and read from that shuffle twice: once to cut the starts that
    others need, once to be edited.  Keys and fingerprints travel as thin rows.
    """
    rows = docs.select(key_column(key).alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    marked = lambda df: df.withColumns({"h": F.xxhash64("t"), "n": F.length("t")})
    thin = materialize(marked(rows).select("k", "h", "n"), "fingerprint-rows")
    following = materialize(next_rows(thin), "fingerprint-next")

    wanted = following.select(
        F.col("next_k").alias("k"), "next_h", "next_n", F.col("k").alias("for_k"), "most"
    )
    # Not an equality of the join, so that both joins use the one shuffle of texts by key.
    chosen = (F.col("h").bitwiseXOR(F.col("next_h")) == 0) & (F.col("n") - F.col("next_n") == 0)
    starts = (
        marked(rows.join(wanted, "k"))
        .where(chosen)
        .select(F.col("for_k").alias("k"), F.expr("substring(t, 1, most div 3)").alias("start"))
        .groupBy("k")
        .agg(F.min("start").alias("start"))
    )
    both = marked(rows.join(starts, "k"))
    edited = F.expr("concat(substring(t, 1, n - n div 3), substring(start, 1, n div 3))")
    both = both.select("k", "h", "n", "t", edited.alias("edited"))
    both = with_fingerprint(with_fingerprint(both, "t", "own"), "edited", "changed").drop("t")
    sha = F.sha2("edited", 256).alias("edited_sha256")
    found = materialize(both.select("k", "h", "n", sha, "own", "changed"), "fingerprint-edited")

    other = ["next_k", "next_h", "next_n"]
    prints = found.select(*(F.col(c[5:]).alias(c) for c in other), F.col("own").alias("next_own"))
    pairs = found.join(following.drop("most"), "k").join(prints.dropDuplicates(other), other)
    return pairs.select(
        key_back("k").alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        F.col("own").alias("fingerprint"),
        F.col("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "next_own").alias("near_next"),
    )
