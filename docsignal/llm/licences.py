"""Licence scans: a trained classifier proposes families, templates confirm them.

A paragraph is a run of lines without a blank line (one without words; comment marks such as ``*``
or ``#`` are no words).  Each line is cut into overlapping windows of words, and so is each paragraph
across its line breaks, so that wrapped notices are seen whole.  A multinomial logistic
regression over hashed word unigrams and bigrams, fitted here, gives each window a probability for
every licence family, for licence-like text of no known family, and for ordinary text.  Its scores
are calibrated by a temperature fitted on held-out rows; a window that looks like a licence but
whose best family stays below the threshold is ``unknown``.  A family is reported only if the text
around the window also contains most of a template of that family (``CONFIRM``); otherwise it is
``unknown`` too, or nothing if there is hardly any likeness (``HINT``).  Of families whose templates
are nearly alike (GPL, LGPL, AGPL) the one whose template is contained best is reported.

Training rows are the templates below, altered at random, and lines of a bounded sample of the
corpus (``SAMPLE_DOCS`` documents, those whose hashed keys are smallest), labelled by template
comparison.  The scan itself reads every whole text.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from docsignal.llm.common import (
    SLICE_BYTES, PrefixHash, ascii_lower, map_batches, mix, text_buffer, text_slices, word_spans,
)

BUCKETS = 1 << 14
WINDOW, STRIDE, CONTEXT = 12, 6, 24  # words
SAMPLE_DOCS = 1000
SAMPLE_LINES = 8000
COPIES = 24
CONFIRM, HINT = 0.7, 0.3
PRECISION = 0.99
NONE, OTHER, UNKNOWN = "none", "other", "unknown"

# Fixed value: words of these bytes alone frame comments, quotations and boxes.
MARKS = b"#*/%-<>=+~_"

# Short notices and characteristic sentences of common licence families.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "MIT License",
        "The MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file"
        " except in compliance with the License.",
        "Apache License Version 2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the"
        " License is distributed on an \"AS IS\" BASIS",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL version 2 or later.",
        "GNU General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "GNU Lesser General Public License",
        "under the terms of the GNU Lesser General Public License as published by the Free Software"
        " Foundation",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "GNU Affero General Public License",
        "under the terms of the GNU Affero General Public License as published by the Free Software"
        " Foundation",
    ),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to"
        " endorse or promote products derived from this software without specific prior written"
        " permission",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International"
        " License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International"
        " License.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "public-domain": (
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved worldwide."),
}
# Licence-like sentences that name no known family ({} is a made-up name).
GENERIC = (
    "Licensed under the {} license.",
    "Released under the terms of the {} Public License, version 2.",
    "Use of this material is subject to the {} license agreement.",
    "This work is distributed under the {} licence.",
    "See the {} license file for details.",
)

FOUND = (
    "doc_id long, spans array<struct<start: long, end: long, family: string, proposed: string,"
    " probability: double, similarity: double>>"
)


def word_hashes(data: np.ndarray, offsets: np.ndarray, hasher: PrefixHash):
    """``(start, end, line id, row, hash)`` of the words of a slice, without punctuation and marks."""
    lowered = ascii_lower(data)
    plain = lowered.copy()
    plain[np.isin(plain, np.frombuffer(b".,;:!?\"'()[]|", np.uint8))] = 32
    start, end, row = word_spans(plain, offsets)
    solid = np.cumsum(np.append(0, ~np.isin(plain, np.frombuffer(MARKS, np.uint8))))
    said = solid[end] > solid[start]
    start, end, row = start[said], end[said], row[said]
    lines = np.cumsum(np.append(data == 10, False))
    hashes = hasher.span(hasher.sums(plain), start, end)
    return start, end, lines[start] if len(start) else start, row, hashes


def paragraphs(line: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The paragraph of each word: a new one after a blank line and with each row."""
    fresh = np.zeros(len(line), np.int64)
    fresh[1:] = (line[1:] - line[:-1] > 1) | (row[1:] != row[:-1])
    return np.cumsum(fresh)


def feature_buckets(hashes: np.ndarray, part: np.ndarray, row: np.ndarray):
    """Buckets of each word and of each word with its follower, and whether the follower counts.

    A follower counts within the same ``part`` (line or paragraph) of a row.
    """
    single = (mix(hashes) >> np.uint64(50)).astype(np.int64)
    pair = np.zeros(len(hashes), np.int64)
    joined = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        both = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
        pair[:-1] = (mix(both) >> np.uint64(50)).astype(np.int64)
        joined[:-1] = (part[:-1] == part[1:]) & (row[:-1] == row[1:])
    return single, pair, joined


@dataclass(frozen=True)
class LicenceModel:
    """Classes, their weights over ``BUCKETS``, temperature and the threshold for a family."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, sums: np.ndarray, features: np.ndarray) -> np.ndarray:
        scores = (sums / np.sqrt(np.maximum(features, 1))[:, None] + self.bias) / self.temperature
        scores -= scores.max(axis=1, keepdims=True)
        raised = np.exp(scores)
        return raised / raised.sum(axis=1, keepdims=True)


def words_of(text: str) -> list[str]:
    found = re.sub(r"[.,;:!?\"'()\[\]|]", " ", text.lower()).split()
    return [w for w in found if w.strip(MARKS.decode())]


def _bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:])) or {(w, "") for w in words}


GENERIC_PATTERNS = [
    {b for b in _bigrams(words_of(t.format("{}"))) if "{}" not in b} for t in GENERIC
]
PATTERNS = {f: [_bigrams(words_of(t)) for t in ts] for f, ts in TEMPLATES.items()}


def similarity(words: list[str], family: str) -> float:
    """The largest share of a template of ``family`` that stands in ``words``."""
    own = _bigrams(words)
    return max(len(own & t) / len(t) for t in PATTERNS[family])


def confirmed(words: list[str], proposed: str) -> tuple[str, float]:
    """``proposed`` or a family nearly alike that the words contain better, and its similarity."""
    own = _bigrams(words)
    share, pattern = max(((len(own & t) / len(t), t) for t in PATTERNS[proposed]), key=lambda x: (x[0], len(x[1])))
    best = (share, proposed)
    for family, patterns in PATTERNS.items():
        for other in patterns if family != proposed else ():
            value = len(own & other) / len(other)
            if value > best[0] and len(pattern & other) >= CONFIRM * min(len(pattern), len(other)):
                best = (value, family)
    return best[1], best[0]


def generic_similarity(words: list[str]) -> float:
    """The largest share of a generic notice that stands in ``words``."""
    own = _bigrams(words)
    return max(len(own & t) / len(t) for t in GENERIC_PATTERNS)


def closest(words: list[str]) -> tuple[str, float]:
    """The family whose template is contained best; of equals, the one with the longest template."""
    own = _bigrams(words)
    value, _, family = max(
        (len(own & t) / len(t), len(t), f) for f, templates in PATTERNS.items() for t in templates
    )
    return family, value


# ---- training -----------------------------------------------------------------------------------


def training_rows(
    lines: list[str], around_lines: list[str] | None = None, seed: int = 7
) -> list[tuple[str, str]]:
    """``(text, class)`` rows: altered templates, generic notices, and labelled corpus lines.

    A line is ordinary text only if what stands around it (``around_lines``) holds no notice either.
    """
    chance = random.Random(seed)
    names = [w for line in lines[:500] for w in line.split()[:2]] or ["Sample"]
    ordinary = [" ".join(line.split()[:WINDOW]) for line in lines]
    rows = []

    def around(text: str) -> str:
        if ordinary and chance.random() < 0.5:
            words = chance.choice(ordinary).split()[: chance.randrange(1, WINDOW // 2)]
            text = f"{text} {' '.join(words)}" if chance.random() < 0.5 else f"{' '.join(words)} {text}"
        return part(text, WINDOW)

    def part(text: str, size: int) -> str:
        words = text.split()
        at = chance.randrange(max(1, len(words) - size + 1))
        return " ".join(words[at : at + size])

    for family, templates in TEMPLATES.items():
        for text in templates:
            rows.append((text, family))
            for _ in range(COPIES):
                kept = [w for w in text.split() if chance.random() > 0.05] or text.split()
                rows.append((around(" ".join(kept)), family))
    for text in GENERIC:
        for _ in range(3 * COPIES):
            rows.append((around(text.format(chance.choice(names))), OTHER))
    for line, nearby in zip(lines, around_lines or lines):
        family, value = closest(words_of(line))
        if value >= 0.9:
            rows.append((line, family))
        elif value < 0.5 and closest(words_of(nearby))[1] < 0.5:
            rows.append((part(line, chance.randrange(3, WINDOW + 1)), NONE))
    chance.shuffle(rows)
    return rows


def _features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket indices and values (counts over the root of the number of features) of each text."""
    data, offsets = text_buffer(pa.array([t.replace("\n", " ") for t in texts], pa.string()))
    _, _, line, row, hashes = word_hashes(data, offsets, PrefixHash())
    single, pair, joined = feature_buckets(hashes, line, row)
    out = []
    for i in range(len(texts)):
        own = row == i
        found = np.concatenate([single[own], pair[own & joined]])
        at, n = np.unique(found, return_counts=True)
        out.append((at, n / np.sqrt(max(1, len(found)))))
    return out


def fit(spark: SparkSession, rows: list[tuple[str, str]]) -> LicenceModel:
    """Fit on two thirds of the rows; temperature and threshold on the rest."""
    names = [NONE, OTHER, *TEMPLATES]
    label = np.array([names.index(c) for _, c in rows])
    features = _features([t for t, _ in rows])
    held = np.arange(len(rows)) % 3 == 2
    table = [
        (float(label[i]), Vectors.sparse(BUCKETS, features[i][0].tolist(), features[i][1].tolist()))
        for i in np.flatnonzero(~held)
    ]
    # Every class takes part even if the sample has none of it.
    table += [(float(c), Vectors.sparse(BUCKETS, [], [])) for c in range(len(names))]
    fitted = LogisticRegression(
        family="multinomial", regParam=1e-4, maxIter=60, standardization=False
    ).fit(spark.createDataFrame(table, ["label", "features"]))
    weights = fitted.coefficientMatrix.toArray().T
    bias = fitted.interceptVector.toArray()
    scores = np.array([(weights[at] * v[:, None]).sum(axis=0) for at, v in (features[i] for i in np.flatnonzero(held))])
    scores = scores.reshape(-1, len(names)) + bias
    truth = label[held]
    temperature, threshold = calibrate(scores, truth)
    return LicenceModel(
        names, np.ascontiguousarray(weights, np.float32), bias, temperature, threshold
    )


def calibrate(scores: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """The temperature of least log-loss, and the least threshold with the wanted precision."""
    if not len(truth):
        return 1.0, 0.5

    def probabilities(t: float) -> np.ndarray:
        z = scores / t
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    grid = np.geomspace(0.25, 4, 33)
    at = np.arange(len(truth))
    loss = [-np.log(np.maximum(probabilities(t)[at, truth], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = probabilities(temperature)
    best = p[:, 2:].argmax(axis=1) + 2
    value, right = p[at, best], best == truth
    for threshold in np.linspace(0.3, 0.95, 14):
        taken = value >= threshold
        if not taken.any() or right[taken].mean() >= PRECISION:
            return temperature, float(threshold)
    return temperature, 0.95


def sample_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text"
) -> tuple[list[str], list[str]]:
    """Lines of the ``SAMPLE_DOCS`` documents with the smallest hashed keys (bounded, repeatable).

    Beside them, each line with the beginnings of the three lines before and after it.
    """
    ids = docs.select(F.col(key).alias("k")).where("k is not null").distinct()
    chosen = ids.orderBy(F.xxhash64("k"), "k").limit(SAMPLE_DOCS)
    whole = docs.join(F.broadcast(chosen), docs[key] == F.col("k")).select(
        "k", F.split(F.col(text), "\n").alias("all")
    )
    # Each line gets its neighbours before the sort, which must not carry whole texts.
    beside = F.expr(
        "transform(all, (x, i) -> struct(x as line, concat_ws('\n', transform(slice(all,"
        " greatest(i - 2, 1), i - greatest(i - 2, 1) + 5), y -> substring(y, 1, 300))) as near))"
    )
    lines = whole.select("k", F.posexplode(beside).alias("at", "l")).select("k", "at", "l.line", "l.near")
    rows = lines.where("trim(line) != ''").orderBy(F.xxhash64("k", "at"), "k", "at", "line", "near")
    found = rows.limit(SAMPLE_LINES).select(F.substring("line", 1, 2000).alias("line"), "near").collect()
    return [r["line"] for r in found], [f"{r['line']}\n{r['near']}" for r in found]


# ---- scanning -----------------------------------------------------------------------------------


def windows(line: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end word of overlapping windows; none crosses a line (or what ``line`` numbers)."""
    if not len(line):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = np.ones(len(line), bool)
    fresh[1:] = (line[1:] != line[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    size = np.diff(np.append(first, len(line)))
    n = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    start = np.repeat(first, n) + STRIDE * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    return start, np.minimum(start + WINDOW, np.repeat(first + size, n))


def scan(docs: DataFrame, model: LicenceModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row: byte spans of licence-like paragraphs with their families.

    ``family`` is confirmed by a template or ``unknown``; ``proposed`` is the classifier's best.
    NULL and empty texts have no spans.  NULL keys and repeated rows are kept as they come; other
    columns are ignored; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = shared.value, PrefixHash()
        for batch in batches:
            for i, j, data, offsets in text_slices(*text_buffer(batch.column(1)), SLICE_BYTES // 2):
                found: list[list[dict]] = [[] for _ in range(j - i)]
                start, end, line, row, hashes = word_hashes(data, offsets, hasher)
                if len(start):
                    part = paragraphs(line, row)
                    single, pair, joined = feature_buckets(hashes, part, row)
                    for span in _candidates(model, single, pair, joined, line, part, row):
                        _report(model, data, offsets, start, end, part, row, span, found)
                    found = [_merged(entries) for entries in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(found, SPANS)],
                    names=["doc_id", "spans"],
                )

    return map_batches(docs.select(key, text), run, FOUND)


SPANS = pa.list_(
    pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()),
         ("proposed", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64())]
    )
)


def _candidates(model, single, pair, joined, line, part, row):
    """``(first word, end word, crosses a line, probabilities)`` of windows that look like a licence."""
    a = np.zeros((len(single) + 1, len(model.names)))
    np.cumsum(model.weights[single], axis=0, out=a[1:])
    b = np.zeros_like(a)
    np.cumsum(model.weights[pair] * joined[:, None], axis=0, out=b[1:])
    pairs = np.concatenate([[0], np.cumsum(joined)])
    (first, end), (wide, wide_end) = windows(line, row), windows(part, row)
    crosses = line[wide] != line[wide_end - 1]
    first = np.append(first, wide[crosses])
    crossing = np.arange(len(first)) >= len(end)
    end = np.append(end, wide_end[crosses])
    sums = a[end] - a[first] + b[end - 1] - b[first]
    count = end - first + pairs[end - 1] - pairs[first]
    p = model.probabilities(sums, count)
    for n in np.flatnonzero(p[:, 0] < 0.5):
        yield int(first[n]), int(end[n]), bool(crossing[n]), p[n]


def _report(model, data, offsets, start, end, part, row, span, found) -> None:
    first, stop, crossing, p = span
    doc = int(row[first])
    best = int(p[2:].argmax()) + 2
    proposed, probability = model.names[best], float(p[best])
    lo, hi = max(first - CONTEXT, 0), min(stop + CONTEXT, len(start))
    while part[lo] != part[first]:
        lo += 1
    while part[hi - 1] != part[first]:
        hi -= 1
    words = words_of(bytes(data[start[lo] : end[hi - 1]]).decode("utf-8", "replace"))
    family, alike = confirmed(words, proposed)
    sure = probability >= model.threshold and alike >= CONFIRM
    if not sure and max(alike, generic_similarity(words)) < HINT:
        return  # nothing but the classifier speaks for a licence
    a, b = int(start[first] - offsets[doc]), int(end[stop - 1] - offsets[doc])
    entry = {
        "start": a, "end": b, "family": family if sure else UNKNOWN, "proposed": proposed,
        "probability": probability, "similarity": alike,
    }
    found[doc].append((crossing, entry))


def _merged(entries: list[tuple[bool, dict]]) -> list[dict]:
    """The spans of a document: windows of a family that meet become one span.

    A window across lines that confirms nothing counts only where no other window speaks, and an
    unknown span within a confirmed one is part of that notice.
    """
    clear = [e for crossing, e in entries if not crossing or e["family"] != UNKNOWN]
    taken = _joined(clear)
    faint = [
        e for crossing, e in entries
        if crossing and e["family"] == UNKNOWN
        and not any(t["start"] < e["end"] and e["start"] < t["end"] for t in taken)
    ]
    spans = _joined(taken + faint)
    sure = [e for e in spans if e["family"] != UNKNOWN]
    return [
        e for e in spans
        if e["family"] != UNKNOWN or not any(s["start"] <= e["start"] and e["end"] <= s["end"] for s in sure)
    ]


def _joined(entries: list[dict]) -> list[dict]:
    spans: list[dict] = []
    last: dict[str, int] = {}
    for entry in sorted(entries, key=lambda e: (e["start"], e["end"])):
        at = last.get(entry["family"])
        if at is not None and spans[at]["end"] >= entry["start"]:
            better = max(spans[at], entry, key=lambda e: e["probability"])
            ends = max(spans[at]["end"], entry["end"])
            spans[at] = better | {"start": spans[at]["start"], "end": ends}
        else:
            last[entry["family"]] = len(spans)
            spans.append(entry)
    return spans


def scan_corpus(docs: DataFrame) -> DataFrame:
    """Fit on the bounded sample of ``docs`` and scan all of it."""
    model = fit(docs.sparkSession, training_rows(*sample_lines(docs)))
    return scan(docs, model)
