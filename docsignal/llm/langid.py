"""Language identification as inference of a mixture of languages.

A model holds, for every learned language, the log-probability of hashed byte trigrams of letter
runs.  A document is a mixture: each of its words (letter runs) comes from one language, with the
document's proportions.  Expectation-maximisation estimates the proportions from the words' trigram
likelihoods.  The set of languages is then chosen by penalised likelihood: languages are ranked by
proportion and the set of the first k that maximises ``log-likelihood - penalty * k * log(words)``
is taken, with proportions estimated anew for each candidate set.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from docsignal.llm.common import SLICE_BYTES, ascii_lower, map_batches, text_buffer, text_slices

BUCKETS = 1 << 16
MAX_LANGUAGES = 512
UNDETERMINED = "und"
SMOOTHING = 0.5
PENALTY = 1.0
STEPS = 8
HELD_OUT = 1  # of crc32(key as text) mod 3

PREDICTED = "doc_id long, lang_pred string, score double, langs array<string>, proportions array<double>"


@dataclass(frozen=True)
class LanguageModel:
    """Learned language names and their trigram log-probabilities, ``BUCKETS x languages``."""

    names: list[str]
    table: np.ndarray


def held_out(key: str = "doc_id") -> Column:
    """Whether a key belongs to the held-out third (a NULL key does not)."""
    crc = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    return crc % 3 == HELD_OUT


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(start, end, row, trigram bucket per byte, lowered letters)`` of a slice of texts.

    A letter is an ASCII letter or any byte beyond ASCII; all else separates words.  The bucket at a
    byte is that of the trigram around it, with a blank where the word ends.
    """
    letters = ascii_lower(data)
    inside = ((letters >= 97) & (letters <= 122)) | (letters >= 128)
    letters = np.where(inside, letters, np.uint8(32))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    first[inner] |= inside[inner]
    last[inner - 1] |= inside[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    wide = letters.astype(np.uint32)
    before, after = np.empty_like(wide), np.empty_like(wide)
    before[1:], after[:-1] = wide[:-1], wide[1:]
    before[start], after[end - 1] = 32, 32
    code = (before << np.uint32(16)) | (wide << np.uint32(8)) | after
    bucket = (code * np.uint32(2654435761)) >> np.uint32(16)
    return start, end, np.searchsorted(offsets, start, "right") - 1, bucket, inside


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Trigram counts of all whole texts of ``docs`` whose language is not NULL.

    Counts are summed on the executors; the model, ``BUCKETS`` numbers a language, is all that
    reaches the driver.  More than ``MAX_LANGUAGES`` languages are refused.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            for i, j, data, offsets in text_slices(*text_buffer(batch.column(0))):
                _, _, _, bucket, inside = letter_runs(data, offsets)
                row = np.repeat(np.arange(j - i), np.diff(offsets))
                for name in set(names[i:j]):
                    chosen = inside & (names[i:j] == name)[row]
                    found = np.bincount(bucket[chosen], minlength=BUCKETS)
                    counts[name] = counts.get(name, 0) + found
        for name, found in counts.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                 pa.array(found[at].astype(np.int64))],
                names=["lang", "bucket", "n"],
            )

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang)
    sums = map_batches(rows, run, "lang string, bucket int, n long").groupBy("lang", "bucket")
    found = sums.agg(F.sum("n").alias("n")).toArrow()
    langs = found["lang"].to_pylist()
    names = sorted(set(langs))
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; at most {MAX_LANGUAGES} can be learned")
    table = np.full((BUCKETS, len(names)), SMOOTHING)
    place = {name: i for i, name in enumerate(names)}
    at = np.array([place[x] for x in langs], np.int64)
    np.add.at(table, (found["bucket"].to_numpy(), at), found["n"].to_numpy())
    table = np.log(table / table.sum(axis=0, keepdims=True)) if names else table
    return LanguageModel(names, np.ascontiguousarray(table, np.float32))


def estimate(
    likelihood: np.ndarray, first: np.ndarray, size: np.ndarray, start: np.ndarray, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each document and its log-likelihood, by expectation-maximisation.

    ``likelihood`` has a line per word (scaled by any factor per word), ``first`` and ``size`` say
    which words a document has, ``start`` has its initial proportions (0 keeps a language out).
    """
    weights = start
    for _ in range(steps):
        share = likelihood * np.repeat(weights, size, axis=0)
        share /= share.sum(axis=1, keepdims=True)
        weights = np.add.reduceat(share, first, axis=0) / size[:, None]
    total = (likelihood * np.repeat(weights, size, axis=0)).sum(axis=1)
    return weights, np.add.reduceat(np.log(total), first)


def most_likely(
    likelihood: np.ndarray, first: np.ndarray, size: np.ndarray, weights: np.ndarray, value: np.ndarray
) -> np.ndarray:
    """An upper bound of each document's log-likelihood over all proportions.

    ``value`` is the log-likelihood at ``weights``.  By Jensen's inequality no proportions exceed it by
    more than the log of the largest mean ratio of a language's likelihood to the mixture's, a word.
    """
    mixture = (likelihood * np.repeat(weights, size, axis=0)).sum(axis=1, keepdims=True)
    ratio = np.add.reduceat(likelihood / mixture, first, axis=0).max(axis=1) / size
    return value + size * np.log(np.maximum(ratio, 1.0))


def infer(words: np.ndarray, row: np.ndarray, rows: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """``(proportions, chosen)`` of each row from its words' log-likelihoods (rows x languages).

    Rows without words have proportions 0 and nothing chosen.
    """
    languages = words.shape[1]
    proportions, chosen = np.zeros((rows, languages)), np.zeros((rows, languages), bool)
    if not len(words) or not languages:
        return proportions, chosen
    docs, first, size = np.unique(row, return_index=True, return_counts=True)
    scale = words.max(axis=1, keepdims=True)
    likelihood = np.maximum(np.exp(words - scale), 1e-30)
    even = np.full((len(docs), languages), 1.0 / languages)
    weights, full = estimate(likelihood, first, size, even)
    # The estimate need not have converged, so it is no bound itself.
    full = most_likely(likelihood, first, size, weights, full)
    order = np.argsort(-weights, axis=1, kind="stable")
    alone = np.add.reduceat(words - scale, first, axis=0)
    best_one = order[:, 0]
    score = alone[np.arange(len(docs)), best_one] - penalty * np.log(size + 1)
    picked = np.zeros((len(docs), languages), bool)
    picked[np.arange(len(docs)), best_one] = True
    final = picked.astype(float)
    for k in range(2, languages + 1):
        # No larger set can be more likely than all languages together.
        open_ = np.flatnonzero(full - penalty * k * np.log(size + 1) > score)
        if not len(open_):
            break
        own = np.isin(row, docs[open_])
        sub = likelihood[own]
        n = size[open_]
        at = np.concatenate([[0], np.cumsum(n)[:-1]])
        among = np.zeros((len(open_), languages))
        np.put_along_axis(among, order[open_, :k], 1.0 / k, axis=1)
        part, value = estimate(sub, at, n, among)
        value = value - penalty * k * np.log(n + 1)
        better = value > score[open_]
        won = open_[better]
        score[won], picked[won], final[won] = value[better], among[better] > 0, part[better]
    proportions[docs], chosen[docs] = np.where(final > 0, final, 0), picked
    # A document of one language still tells how mixed its words looked.
    single = picked.sum(axis=1) == 1
    proportions[docs[single]] = np.where(picked[single], weights[single], 0)
    return proportions, chosen


def predict(
    docs: DataFrame,
    model: LanguageModel,
    key: str = "doc_id",
    text: str = "text",
    penalty: float = PENALTY,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, lang_pred, score, langs, proportions`` of every row, from its whole text alone.

    Columns named in ``carry`` are passed through beside them.

    ``langs`` is the chosen set, by falling proportion, ``lang_pred`` its first, ``score`` that
    one's proportion.  NULL, empty or letterless text, or a model without languages: ``und``, 0,
    empty lists.  Ties go to the alphabetically first language.  NULL keys and repeated rows are
    kept as they come; other columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value.names, shared.value.table
        limit = max(1 << 16, SLICE_BYTES // max(1, len(names) // 4))
        for batch in batches:
            texts = batch.column(1)
            for i, j, data, offsets in text_slices(*text_buffer(texts), limit):
                start, end, row, bucket, _ = letter_runs(data, offsets)
                if len(start) and names:
                    ends = np.empty(2 * len(start), np.int64)
                    ends[0::2], ends[1::2] = start, end
                    sums = np.add.reduceat(
                        table[np.append(bucket, 0)], ends, axis=0
                    )[0::2].astype(np.float64)
                else:
                    sums, row = np.zeros((0, len(names))), row[:0]
                plain = (data >= 65) & (data <= 90) | (data >= 97) & (data <= 122)
                has = np.add.reduceat(np.append(plain, False), offsets[:-1]) > 0 if j > i else []
                has = np.where(np.diff(offsets) > 0, has, False)
                for n in np.flatnonzero(~has & (np.diff(offsets) > 0)):
                    has[n] = regex.search(r"\p{L}", texts[i + int(n)].as_py()) is not None
                proportions, chosen = infer(sums, row, j - i, penalty)
                own = _rows(batch.column(0).slice(i, j - i), names, proportions, chosen, has)
                extra = [c.slice(i, j - i) for c in batch.columns[2:]]
                yield pa.RecordBatch.from_arrays([*own.columns, *extra], names=fields)

    rows = docs.select(key, text, *[F.col(c).alias(f"carry_{c}") for c in carry])
    types = [docs.schema[c].dataType.simpleString() for c in carry]
    schema = ", ".join([PREDICTED, *(f"`{c}` {t}" for c, t in zip(carry, types))])
    fields = ["doc_id", "lang_pred", "score", "langs", "proportions", *carry]
    return map_batches(rows, run, schema)


def _rows(keys, names, proportions, chosen, has) -> pa.RecordBatch:
    best, score, langs, parts = [], [], [], []
    for p, c, known in zip(proportions, chosen, has):
        if not known or not c.any():
            best.append(UNDETERMINED)
            score.append(0.0)
            langs.append([])
            parts.append([])
            continue
        order = [int(n) for n in np.argsort(-p, kind="stable") if c[n]]
        best.append(names[order[0]])
        score.append(float(min(1.0, p[order[0]])))
        langs.append([names[n] for n in order])
        parts.append([float(p[n]) for n in order])
    return pa.RecordBatch.from_arrays(
        [keys.cast(pa.int64()), pa.array(best, pa.string()), pa.array(score, pa.float64()),
         pa.array(langs, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64()))],
        names=["doc_id", "lang_pred", "score", "langs", "proportions"],
    )


def identify(docs: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """Learn from the rows that are not held out and predict all rows.

    Returns ``predict``'s columns and ``held_out``.
    """
    model = learn(docs.where(~held_out()))
    return predict(docs, model, penalty=penalty).withColumn("held_out", held_out())
