import random

import numpy as np
import pytest

from docsignal.llm import licences
from helpers import documents, edge_rows, empty, words


@pytest.fixture(scope="module")
def model(spark):
    lines = [" ".join(words(i, 5 + i % 40, 3000)) + "." for i in range(600)]
    return licences.fit(spark, licences.training_rows(lines))


def families(found):
    return {r.doc_id: sorted({s.family for s in r.spans}) for r in found.collect()}


def test_planted_notices_are_found(spark, model):
    chance = random.Random(2)
    rows, wanted = [], {}
    notices = [(f, t) for f, ts in licences.TEMPLATES.items() for t in ts]
    for i, (family, notice) in enumerate(notices):
        before, after = (" ".join(words(chance.random(), 60, 3000)) for _ in range(2))
        rows.append((i, f"{before}\n{notice}\n{after}"))
        wanted[i] = family
        rows.append((i + 500, f"{before} {after}"))
        wanted[i + 500] = None
    got = families(licences.scan(documents(spark, rows), model))
    right = sum((wanted[k] in got[k]) if wanted[k] else not got[k] for k in wanted)
    assert right >= len(wanted) - 2
    assert all(not got[k] for k in wanted if wanted[k] is None)


def test_a_notice_inside_a_long_line(spark, model):
    line = " ".join(words(1, 300, 3000)) + " Released under the MIT License. " + " ".join(words(2, 300, 3000))
    found = licences.scan(documents(spark, [(1, line)]), model).first().spans
    assert "mit" in {s.family for s in found}
    span = next(s for s in found if s.family == "mit")
    assert "Released under the MIT License" in line.encode()[span.start : span.end].decode()


def test_unknown_licences_are_not_named(spark, model):
    rows = [(1, "Licensed under the Quuxly license."), (2, "Use of this material is subject to the Zonk license agreement.")]
    for found in families(licences.scan(documents(spark, rows), model)).values():
        assert found in ([], ["unknown"])


def test_calibration_prefers_the_right_temperature():
    rng = np.random.default_rng(1)
    logits = rng.normal(0, 3, (4000, 5))
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    truth = np.array([rng.choice(5, p=x) for x in p])
    temperature, _ = licences.calibrate(logits * 2.0, truth)
    assert 1.6 < temperature < 2.5


def test_windows_cover_every_word_and_stay_in_lines():
    rng = np.random.default_rng(2)
    line = np.repeat(np.arange(20), rng.integers(1, 120, 20))
    first, end = licences.windows(line, np.zeros(len(line), int))
    seen = np.zeros(len(line), bool)
    for a, b in zip(first, end):
        assert 0 < b - a <= licences.WINDOW and line[a] == line[b - 1]
        seen[a:b] = True
    assert seen.all()


# Wrapped as they stand in source files; none is a template.
WRAPPED = [
    ("mit", """The MIT License (MIT)

Copyright (c) 2019 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""),
    ("mit", """The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""),
    ("lgpl", """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""),
    ("agpl", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""),
    ("bsd", """Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above"""),
    ("mit", "The code in this folder is available under the terms of\nthe MIT License; see COPYING."),
    ("gpl", "You should have received a copy of the GNU General Public\nLicense along with this program."),
]


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_wrapped_notices_are_found(spark, model, mark):
    rows, wanted = [], {}
    for i, (family, notice) in enumerate(WRAPPED):
        before, after = (" ".join(words(i + n, 40, 3000)) for n in (100, 200))
        marked = "\n".join(mark + line for line in notice.split("\n"))
        rows.append((i, f"{before}\n\n{marked}\n\n{after}"))
        wanted[i] = [family]
    got = families(licences.scan(documents(spark, rows), model))
    assert {k: [f for f in v if f != "unknown"] for k, v in got.items()} == wanted


def test_windows_cross_line_breaks_but_no_blank_line_and_no_document(spark, model):
    cut = ["Permission is hereby granted, free of charge, to any person", "obtaining a copy of this software and associated documentation files"]
    rows = [(1, "\n".join(cut)), (2, "\n\n".join(cut)), (3, cut[0]), (4, cut[1])]
    got = families(licences.scan(documents(spark, rows).coalesce(1), model))
    assert got[1] == ["mit"]
    assert all("mit" not in got[k] for k in (2, 3, 4))


def test_lines_around_a_notice_of_its_own_line_stay_ordinary(spark, model):
    lines = [" ".join(words(i, 9, 3000)) for i in range(20)]
    notice = "Released under the MIT License."
    text = "\n".join([*lines[:10], notice, *lines[10:]])
    spans = licences.scan(documents(spark, [(1, text)]), model).first().spans
    assert [s.family for s in spans] == ["mit"] and notice[:-1] in text[spans[0].start : spans[0].end]


def test_pieces_of_a_wrapped_notice_are_no_ordinary_training_lines(spark):
    text = "\n".join([WRAPPED[2][1], *(" ".join(words(i, 9, 3000)) for i in range(40))])
    rows = licences.training_rows(*licences.sample_lines(documents(spark, [(1, text)])))
    ordinary = " ".join(t for t, c in rows if c == licences.NONE)
    assert ordinary and "Free Software" not in ordinary


def test_edges(spark, model):
    rows = edge_rows()
    found = licences.scan(documents(spark, rows, clashing=True), model).collect()
    assert len(found) == len(rows) and all(r.spans == [] for r in found)
    assert licences.scan(empty(spark), model).count() == 0
    assert licences.scan_corpus(empty(spark)).count() == 0


def test_windows_equal_a_plain_loop(model):
    """Prefix sums, window bounds and offsets beside the features of every window taken by itself."""
    chance = random.Random(11)
    notices = [" ".join(licences.words_of(t)) for ts in licences.TEMPLATES.values() for t in ts]
    texts = [" ".join(words(3, 20_000, 5000)), "", "one", "a b c\n\n\n" + notices[0]]
    for i in range(40):
        lines = [
            chance.choice(["", " ".join(words(chance.random(), chance.randrange(1, 40), 900)), chance.choice(notices)])
            for _ in range(chance.randrange(1, 9))
        ]
        texts.append("\n".join(lines))

    want, n = {}, 0
    for text in texts:
        paragraph = []

        def close(paragraph):
            flat = [(word, at, line) for line, row in enumerate(paragraph) for word, at in row]
            for group in [[x for x in flat if x[2] == line] for line in range(len(paragraph))] + [flat]:
                step, size = licences.STRIDE, licences.WINDOW
                starts = [0] + [s for s in range(step, len(group), step) if s - step + size < len(group)]
                for s in starts if group else ():
                    part = group[s : s + size]
                    crosses = part[0][2] != part[-1][2]
                    if group is flat and not crosses:
                        continue
                    at, values = licences._features([" ".join(w for w, _, _ in part)])[0]
                    score = ((model.weights[at].astype(float) * values[:, None]).sum(0) + model.bias) / model.temperature
                    raised = np.exp(score - score.max())
                    want[part[0][1], part[-1][1] + 1, crosses] = raised / raised.sum()

        for line in text.split("\n"):
            if line.split():
                paragraph.append([(w, n + i) for i, w in enumerate(line.split())])
                n += len(line.split())
            else:
                close(paragraph)
                paragraph = []
        close(paragraph)

    data, offsets = licences.text_buffer(licences.pa.array(texts, licences.pa.string()))
    start, end, line, row, hashes = licences.word_hashes(data, offsets, licences.PrefixHash())
    part = licences.paragraphs(line, row)
    assert len(start) == n
    single, pair, joined = licences.feature_buckets(hashes, part, row)
    got = {(a, b, c): p for a, b, c, p in licences._candidates(model, single, pair, joined, line, part, row)}
    assert {k for k, p in want.items() if p[0] < 0.4999} <= set(got) <= {k for k, p in want.items() if p[0] < 0.5001}
    assert len(got) > 40 and any(crosses for _, _, crosses in got)
    for k, p in got.items():
        assert p == pytest.approx(want[k], abs=1e-4)
