"""The same results in DuckDB SQL, written independently of the Spark plans.

Model fits have no entry; the tests check them against brute force and by their properties.
"""

from __future__ import annotations

from docsignal.functions import sentiment as V
from docsignal.functions import text as T
from docsignal.functions.stopwords import ENGLISH_STOP_WORDS
from docsignal.operators.prompts import INSTRUCTION
from docsignal.operators.reports import SHORT_NAMES
from docsignal.plans import queries as Q


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) for v in values)


SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
DIGITS = (
    r"[\p{Nd}\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}"
    r"\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}]"
)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _round(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


# --- text signals -----------------------------------------------------------------------------

DOCS = "docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"
LAB_DOCS = (
    "docs AS (SELECT d.doc_id, coalesce(d.text, '') AS t, l.quality AS label "
    "FROM documents d JOIN labels l USING (doc_id))"
)


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(t, {_text(pattern)}))::DOUBLE"


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part}) / ({whole}) ELSE 0.0 END"


SYLLABLES = """greatest(
    len(regexp_extract_all(w, '[aeiouy]+'))
    - CASE WHEN w LIKE '%e' AND len(regexp_extract_all(w, '[aeiouy]+')) > 1 THEN 1 ELSE 0 END
    + CASE WHEN regexp_matches(w, '[^aeiouy]le$') THEN 1 ELSE 0 END, 1)"""

WORDS = """words AS (
  SELECT doc_id, t, length(t)::DOUBLE AS chars, regexp_extract_all(t, '[A-Za-z'']+') AS ws,
    list_transform(regexp_extract_all(t, '[A-Za-z'']+'), lambda w: lower(w)) AS lw,
    len(list_filter(regexp_split_to_array(t, '[.!?]+'),
        lambda s: regexp_matches(s, '[^@SPACE@]')))::DOUBLE AS sents
  FROM docs)""".replace("@SPACE@", SPACE)

_N = "len(ws)::DOUBLE"
STYLE = {
    "char_len": "chars",
    "word_count": _N,
    "avg_word_len": _ratio("list_sum(list_transform(ws, lambda w: length(w)))", _N),
    "unique_word_ratio": _ratio("len(list_distinct(lw))", _N),
    "stopword_ratio": _ratio(
        "(SELECT count(*) FROM unnest(lw) u(w) WHERE w IN (SELECT s FROM stops))", _N
    ),
    "punct_ratio": _ratio(_count(rf"[^\p{{L}}\p{{N}}_{SPACE}]"), "chars"),
    "uppercase_char_ratio": _ratio(_count(r"\p{Lu}"), "chars"),
    "uppercase_word_ratio": _ratio(
        "len(list_filter(ws, lambda w: regexp_matches(w, '^''*([A-Z]''*){3,}$')))", _N
    ),
    "digit_ratio": _ratio(_count(DIGITS), "chars"),
    "url_count": _count(rf"(?i)(https?://[^{SPACE}]+|www\.[^{SPACE}]+)"),
    "exclamation_count": _count("!"),
    "question_count": _count(r"\?"),
    "comma_count": _count(","),
    "period_count": _count(r"\."),
    "colon_semi_count": _count("[:;]"),
    "quote_count": _count("[\"']"),
    "ellipsis_count": _count(r"\.\.\."),
    "parenthesis_count": _count("[()]"),
    "avg_sentence_length_words": _ratio(_N, "sents"),
}
STOPS = f"stops AS (SELECT unnest([{_list(sorted(ENGLISH_STOP_WORDS))}]) AS s)"
STYLED = (
    STOPS
    + ",\nstyled AS (SELECT doc_id, "
    + ", ".join(f"({e})::DOUBLE AS {n}" for n, e in STYLE.items())
    + " FROM words)"
)
READ = f"""syl AS (
  SELECT doc_id, sents, {_N} AS n, list_transform(lw, lambda w: {SYLLABLES}) AS sy FROM words),
counted AS (
  SELECT doc_id, n, sents AS sentence_count,
    coalesce(list_sum(sy), 0)::DOUBLE AS syllable_count,
    len(list_filter(sy, lambda s: s >= 3))::DOUBLE AS complex_word_count FROM syl),
rates AS (
  SELECT *, n / greatest(sentence_count, 1.0) AS wps,
    CASE WHEN n > 0 THEN syllable_count / n ELSE 0.0 END AS spw,
    CASE WHEN n > 0 THEN complex_word_count / n ELSE 0.0 END AS hard FROM counted),
readable AS (
  SELECT doc_id, sentence_count, syllable_count, complex_word_count,
    206.835::DOUBLE - 1.015::DOUBLE * wps - 84.6::DOUBLE * spw AS flesch_reading_ease,
    0.39::DOUBLE * wps + 11.8::DOUBLE * spw - 15.59::DOUBLE AS flesch_kincaid_grade,
    0.4::DOUBLE * (wps + 100.0::DOUBLE * hard) AS gunning_fog_index FROM rates)"""

# --- sentiment --------------------------------------------------------------------------------

DEMO_ROWS = ", ".join(f"({_text(w)}, {v}::DOUBLE)" for w, v in V.DEMO_LEXICON.items())
DEMO_LEXICON = f"lex AS (SELECT * FROM (VALUES {DEMO_ROWS}) v(token, valence))"
DERIVED_LEXICON = f"""demo AS (SELECT * FROM (VALUES {DEMO_ROWS}) v(token, valence)),
found AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark),
derived AS (SELECT w AS token,
    (((ascii(w) + 3 * ascii(substr(w, 2, 1))) % 9) - 4) * 0.7::DOUBLE AS valence
  FROM found WHERE length(w) = 3 AND w NOT IN (SELECT token FROM demo)),
lex AS (SELECT * FROM demo UNION ALL SELECT * FROM derived WHERE valence <> 0)"""
BOOSTS = ", ".join(
    [f"({_text(w)}, {V.BOOST}::DOUBLE)" for w in V.INTENSIFIERS]
    + [f"({_text(w)}, -{V.BOOST}::DOUBLE)" for w in V.DAMPENERS]
)
IDIOM_ROWS = ", ".join(f"({_text(w)}, {v}::DOUBLE)" for w, v in V.IDIOMS.items())


def _distance_step(d: int, source: str) -> str:
    """Booster and negation of the token ``d`` places before, as two CTEs."""
    mul, neg = f"v * {V.NEVER_FACTOR}", f"v * ({V.NEGATION_FACTOR})"
    negates = f"(w{d} IN ({_list(V.NEGATIONS)}) OR contains(w{d}, 'n''t'))"
    special = ""
    if d == 2:
        special = (
            f"WHEN w2 = 'never' AND w1 IN ('so', 'this') THEN {mul} "
            "WHEN w2 = 'without' AND w1 = 'doubt' THEN v "
        )
    if d == 3:
        special = (
            f"WHEN (w3 = 'never' AND w2 IN ('so', 'this')) OR w1 IN ('so', 'this') THEN {mul} "
            "WHEN w3 = 'without' AND (w2 = 'doubt' OR w1 = 'doubt') THEN v "
        )
    return f"""b{d} AS (SELECT * REPLACE (CASE WHEN w{d} IS NOT NULL AND x{d} IS NULL AND b{d} IS NOT NULL
    THEN v + (CASE WHEN v < 0 THEN -b{d} ELSE b{d} END
      + CASE WHEN mixed AND u{d} THEN CASE WHEN v > 0 THEN {V.CAPS_BOOST} ELSE -{V.CAPS_BOOST} END
        ELSE 0 END) * {V.DAMPING[d]} ELSE v END AS v) FROM {source}),
n{d} AS (SELECT * REPLACE (CASE WHEN w{d} IS NULL OR x{d} IS NOT NULL THEN v {special}
    WHEN {negates} THEN {neg} ELSE v END AS v) FROM b{d})"""


_PRIOR = ", ".join(
    f"lag(w, {d}) OVER o AS w{d}, lag(x, {d}) OVER o AS x{d}, lag(b, {d}) OVER o AS b{d}, "
    f"lag(up, {d}) OVER o AS u{d}"
    for d in (1, 2, 3)
)


def _idiom(*words: str) -> str:
    phrase = " || ' ' || ".join(words)
    return f"(SELECT valence FROM idioms WHERE token = {phrase})"


def _ordered_sum(values: str) -> str:
    """Sum in token order: valences may cancel, and then the order decides the last bit."""
    return f"list_reduce(list_prepend(0.0::DOUBLE, {values}), lambda a, b: a + b)"


SENTIMENT = f"""boosts AS (SELECT * FROM (VALUES {BOOSTS}) v(token, boost)),
idioms AS (SELECT * FROM (VALUES {IDIOM_ROWS}) v(token, valence)),
raw AS (SELECT doc_id, regexp_extract_all(t, '[^{SPACE}]+') AS toks FROM docs),
tok AS (SELECT doc_id, unnest(toks) AS tk, generate_subscripts(toks, 1) AS i FROM raw),
bare AS (SELECT doc_id, i, CASE WHEN length(trim(tk, {_text(V.PUNCTUATION)})) <= 2 THEN tk
    ELSE trim(tk, {_text(V.PUNCTUATION)}) END AS tk FROM tok),
low AS (SELECT doc_id, i, lower(tk) AS w, tk = upper(tk) AND tk <> lower(tk) AS up FROM bare),
known AS (SELECT low.*, lex.valence AS x, boosts.boost AS b FROM low
  LEFT JOIN lex ON lex.token = low.w LEFT JOIN boosts ON boosts.token = low.w),
doc AS (SELECT doc_id, count(*) AS n, count(*) FILTER (up) AS n_up, min(i) FILTER (w = 'but') AS but
  FROM low GROUP BY doc_id),
near AS (SELECT known.*, {_PRIOR}, lead(w, 1) OVER o AS a1, lead(w, 2) OVER o AS a2,
    lead(x, 1) OVER o AS ax FROM known WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
hits AS (SELECT near.*, n_up > 0 AND n_up < n AS mixed, but, x AS v FROM near JOIN doc USING (doc_id)
  WHERE x IS NOT NULL AND b IS NULL AND NOT (w = 'kind' AND coalesce(a1, '') = 'of')),
s1 AS (SELECT * REPLACE (CASE
    WHEN w1 = 'no' OR w2 = 'no' OR (w3 = 'no' AND w1 IN ('or', 'nor')) THEN v * ({V.NEGATION_FACTOR})
    WHEN w = 'no' AND ax IS NOT NULL THEN 0 ELSE v END AS v) FROM hits),
s2 AS (SELECT * REPLACE (CASE WHEN mixed AND up
    THEN v + CASE WHEN v > 0 THEN {V.CAPS_BOOST} ELSE -{V.CAPS_BOOST} END ELSE v END AS v) FROM s1),
{_distance_step(1, "s2")},
{_distance_step(2, "n1")},
{_distance_step(3, "n2")},
s3 AS (SELECT * REPLACE (CASE WHEN w3 IS NOT NULL AND x3 IS NULL THEN coalesce(
    {_idiom("w", "a1", "a2")}, {_idiom("w", "a1")}, {_idiom("w1", "w")}, {_idiom("w2", "w1", "w")},
    {_idiom("w2", "w1")}, {_idiom("w3", "w2", "w1")}, {_idiom("w3", "w2")}, v)
    - {V.BOOST} * ((w3 || ' ' || w2 IN ({_list(V.DAMPENER_PHRASES)}))::INT
        + (w2 || ' ' || w1 IN ({_list(V.DAMPENER_PHRASES)}))::INT)
    ELSE v END AS v) FROM n3),
s4 AS (SELECT * REPLACE (CASE WHEN x1 IS NULL AND w1 = 'least' AND coalesce(w2, '') NOT IN ('at', 'very')
    THEN v * ({V.NEGATION_FACTOR}) ELSE v END AS v) FROM s3),
s5 AS (SELECT * REPLACE (CASE WHEN i < but THEN v * {V.BUT_BEFORE} WHEN i > but THEN v * {V.BUT_AFTER}
    ELSE v END AS v) FROM s4),
lists AS (SELECT doc_id, list(v::DOUBLE ORDER BY i) AS vs FROM s5 GROUP BY doc_id),
sums AS (SELECT doc_id, {_ordered_sum("vs")} AS s,
    {_ordered_sum("list_transform(list_filter(vs, lambda v: v > 0), lambda v: v + 1)")} AS p,
    {_ordered_sum("list_transform(list_filter(vs, lambda v: v < 0), lambda v: 1 - v)")} AS g,
    len(list_filter(vs, lambda v: v <> 0)) AS k FROM lists),
marks AS (SELECT doc_id, least(len(regexp_extract_all(t, '!')), {V.EXCLAIM_MAX}) * {V.EXCLAIM_STEP}::DOUBLE
    + CASE WHEN len(regexp_extract_all(t, '\\?')) <= 1 THEN 0
        WHEN len(regexp_extract_all(t, '\\?')) <= 3
        THEN len(regexp_extract_all(t, '\\?')) * {V.QUESTION_STEP}::DOUBLE
        ELSE {V.QUESTION_TOP} END AS e FROM docs),
tally AS (SELECT docs.doc_id, coalesce(s, 0.0) AS s, coalesce(p, 0.0) AS p, coalesce(g, 0.0) AS g,
    coalesce(n, 0) - coalesce(k, 0) AS z, e
  FROM docs JOIN marks USING (doc_id) LEFT JOIN doc USING (doc_id) LEFT JOIN sums USING (doc_id)),
amped AS (SELECT doc_id, z, s + sign(s) * e AS s, p + CASE WHEN p > g THEN e ELSE 0 END AS p,
    g + CASE WHEN g > p THEN e ELSE 0 END AS g FROM tally),
felt AS (SELECT doc_id,
    round(CASE WHEN p + g + z > 0 THEN p / (p + g + z) ELSE 0 END, 3)::DOUBLE AS vader_pos,
    round(CASE WHEN p + g + z > 0 THEN z / (p + g + z) ELSE 0 END, 3)::DOUBLE AS vader_neu,
    round(CASE WHEN p + g + z > 0 THEN g / (p + g + z) ELSE 0 END, 3)::DOUBLE AS vader_neg,
    round(s / sqrt(s * s + {V.NORMALIZER}::DOUBLE), 4)::DOUBLE AS vader_compound FROM amped)"""

ENGINEERED_PARTS = [WORDS, STYLED, READ, DEMO_LEXICON, SENTIMENT]
ENG = (
    "eng AS (SELECT styled.doc_id, "
    + ", ".join(T.ENGINEERED_NAMES)
    + " FROM styled JOIN readable USING (doc_id) JOIN felt USING (doc_id))"
)

# --- TF-IDF -----------------------------------------------------------------------------------

WORD_TERMS = "regexp_extract_all(lower(t), '[\\p{L}\\p{N}_]{2,}')"


def _terms(expression: str) -> str:
    return f"terms AS (SELECT doc_id, unnest({expression}) AS term FROM docs)"


BIGRAMS = f"""tw AS (SELECT doc_id, {WORD_TERMS} AS ws FROM docs),
terms AS (SELECT doc_id, unnest(ws) AS term FROM tw UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))
  FROM tw)"""
CHAR_TERMS = f"""tc AS (SELECT doc_id, regexp_replace(lower(t), '[{SPACE}]{{2,}}', ' ', 'g') AS s FROM docs),
terms AS (SELECT doc_id, unnest(list_transform(range(1, greatest(length(s) - n + 2, 1)),
    lambda i: substr(s, i, n))) AS term FROM tc, (VALUES (3), (4), (5)) z(n))"""


def _fit(n_docs: str, low: str, high: str, top: int, where: str = "true") -> str:
    """Vocabulary and weighted rows from ``terms``; fitted on the rows matching ``where``."""
    return f"""fit AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf_total FROM terms
    WHERE {where} GROUP BY term),
size AS (SELECT {n_docs} AS n),
top AS (SELECT term, df, tf_total FROM fit, size WHERE df >= {low} AND df <= {high}
    ORDER BY tf_total DESC, term LIMIT {top}),
vocab AS (SELECT term, (row_number() OVER (ORDER BY term) - 1)::INT AS idx, df, tf_total,
    ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0::DOUBLE AS idf FROM top, size)"""


WEIGHTS = """tf AS (SELECT doc_id, term, idx, count(*) * any_value(idf) AS w
    FROM terms JOIN vocab USING (term) GROUP BY doc_id, term, idx),
weights AS (SELECT doc_id, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS value FROM tf)"""
ALL_DOCS = "(SELECT count(*) FROM docs)"
WORD_FIT = _fit(ALL_DOCS, "2", "1.0 * n", 200)
VOCAB_OUT = (
    "SELECT term, idx, df::BIGINT AS df, tf_total::BIGINT AS tf_total, round(idf, 6) AS idf FROM vocab"
)
ROWS_OUT = "SELECT doc_id, term, round(value, 6) AS value FROM weights"

# --- splits and features of the labelled corpus -----------------------------------------------


def _ranked(name: str, source: str, seed: int) -> str:
    return (
        f"{name} AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY "
        f"md5('{seed}:' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY label) AS m FROM {source})"
    )


LABELS = "lab AS (SELECT doc_id, quality AS label FROM labels)"
SPLIT_TWO = (
    _ranked("rk", "lab", 42)
    + ",\nsplits AS (SELECT doc_id, label, CASE WHEN r <= round(0.2::DOUBLE * m) THEN 'val' "
    "ELSE 'train' END AS split FROM rk)"
)
SPLIT_THREE = (
    _ranked("rt", "lab", 43)
    + ",\nrest AS (SELECT doc_id, label FROM rt WHERE r > round(0.2::DOUBLE * m)),\n"
    + _ranked("rk", "rest", 42)
    + ",\nsplits AS (SELECT doc_id, label, CASE WHEN r <= round(0.2::DOUBLE * m) THEN 'val' "
    "ELSE 'train' END AS split FROM rk UNION ALL SELECT doc_id, label, 'test' FROM rt "
    "WHERE r <= round(0.2::DOUBLE * m))"
)
IN_TRAIN = "doc_id IN (SELECT doc_id FROM splits JOIN docs USING (doc_id) WHERE split = 'train')"


def _corpus(splits: str) -> list[str]:
    """Splits, engineered block and TF-IDF weights of the labelled documents."""
    lab = "lab AS (SELECT doc_id, quality AS label FROM documents JOIN labels USING (doc_id))"
    count = "(SELECT count(*) FROM splits WHERE split = 'train')"
    return [
        lab, splits, LAB_DOCS, *ENGINEERED_PARTS, ENG, _terms(WORD_TERMS),
        _fit(count, "2", "1.0 * n", Q.TFIDF.max_terms, IN_TRAIN), WEIGHTS,
    ]


_LONG = ",\n    ".join(f"('{n}', {n})" for n in T.ENGINEERED_NAMES)
FEATURE_LONG = (
    _with(*_corpus(SPLIT_TWO))
    + f"""SELECT s.doc_id, s.label, s.split, f.feature, round(f.value, 6) AS value
FROM splits s JOIN (
  SELECT doc_id, u.feature, u.value FROM eng, LATERAL (VALUES {_LONG}) u(feature, value)
  WHERE u.value <> 0
  UNION ALL SELECT doc_id, 'tfidf:' || term, value FROM weights) f USING (doc_id)"""
)
FEATURE_WIDE = (
    _with(
        *_corpus(SPLIT_TWO),
        "wide AS (SELECT doc_id, "
        + ", ".join(
            f"max(value) FILTER (idx = {i}) AS term_{i}" for i in range(Q.TFIDF.max_terms)
        )
        + " FROM weights GROUP BY doc_id)",
    )
    + "SELECT s.doc_id, s.label, s.split, "
    + _round(T.ENGINEERED_NAMES)
    + ", "
    + ", ".join(
        f"round(coalesce(term_{i}, 0.0), 6) AS term_{i}" for i in range(Q.TFIDF.max_terms)
    )
    + " FROM splits s JOIN eng USING (doc_id) LEFT JOIN wide USING (doc_id)"
)


def _number(value: str, digits: int) -> str:
    """A float as Python prints it after rounding."""
    fixed = f"rtrim(printf('%.{digits}f', {value}), '0')"
    return f"CASE WHEN {fixed} LIKE '%.' THEN {fixed} || '0' ELSE {fixed} END"


def _prompt(top_k: int, digits: int, engineered: bool, where: str, tail: str, out: str, splits: str):
    eng_line = (
        "'Engineered: ' || "
        + " || ', ' || ".join(f"'{n}=' || {_number(n, digits)}" for n in T.ENGINEERED_NAMES)
        if engineered
        else "NULL"
    )
    return (
        _with(*_corpus(splits))
        + f""", best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY value DESC, idx) AS r
  FROM weights),
spoken AS (SELECT doc_id, 'Top-TFIDF: ' || string_agg(term || ':' || {_number("value", digits)}, ', '
    ORDER BY r) AS line FROM best WHERE r <= {top_k} GROUP BY doc_id),
lines AS (SELECT s.doc_id, s.label, s.split, coalesce(nullif(concat_ws(chr(10), {eng_line}, line), ''),
    'No signals.') AS signals FROM splits s JOIN eng USING (doc_id) LEFT JOIN spoken USING (doc_id))
SELECT {out.format(prompt=f"{_text(INSTRUCTION)} || chr(10) || chr(10) || 'SIGNALS:' || chr(10) || signals "
                          f"|| chr(10) || chr(10) || 'Answer:' || {tail} AS prompt")}
FROM lines WHERE {where}"""
    )


# --- matrices and outliers --------------------------------------------------------------------

EMB = "emb AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)"
EMB_LONG = (
    EMB + ",\nel AS (SELECT vec_id, label, unnest(e) AS x, generate_subscripts(e, 1) - 1 AS idx FROM emb)"
)
COV = """mu AS (SELECT idx, avg(x) AS m FROM el GROUP BY idx),
c AS (SELECT vec_id, idx, x - m AS z FROM el JOIN mu USING (idx)),
cov AS (SELECT a.idx AS i, b.idx AS j, sum(a.z * b.z) AS g FROM c a JOIN c b USING (vec_id) GROUP BY 1, 2)"""
LEDOIT = """q AS (SELECT count(*)::DOUBLE AS n, sum(s * s) AS quartic
    FROM (SELECT vec_id, sum(z * z) AS s FROM c GROUP BY vec_id)),
k AS (SELECT count(*) FILTER (i = j)::DOUBLE AS p, sum(g) FILTER (i = j) AS tr, sum(g * g) AS fro FROM cov),
b AS (SELECT n, p, tr / n / p AS mu, (quartic / n - fro / (n * n)) / (p * n) AS beta,
    (fro / (n * n) - tr / n * (tr / n / p)) / p AS delta FROM q, k),
sh AS (SELECT n, mu, CASE WHEN least(beta, delta) = 0 THEN 0 ELSE least(beta, delta) / delta END AS s FROM b)"""


def _knn(source: str, ids: str, distance: str, k: int) -> str:
    return f"""pairs AS (SELECT a.{ids} AS id, {distance} AS d FROM {source} a JOIN {source} b
    ON a.{ids} <> b.{ids}),
near AS (SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY d) AS r FROM pairs),
nn AS (SELECT id, d, r FROM near WHERE r <= {k})"""


EUCLID = "list_distance(a.e, b.e)"
MANHATTAN = "list_sum(list_transform(range(1, len(a.e) + 1), lambda i: abs(a.e[i] - b.e[i])))"

PAIRS = [
    DOCS, WORDS, STYLED,
    "pt AS (SELECT doc_id, avg_word_len AS x, unique_word_ratio AS y FROM styled)",
]
SCALED = """zs AS (SELECT avg(x) AS mx, avg(y) AS my,
    CASE WHEN stddev_pop(x) = 0 THEN 1 ELSE stddev_pop(x) END AS sx,
    CASE WHEN stddev_pop(y) = 0 THEN 1 ELSE stddev_pop(y) END AS sy FROM pt),
z AS (SELECT doc_id, (x - mx) / sx AS x, (y - my) / sy AS y FROM pt, zs)"""
CENTRED = """zs AS (SELECT avg(x) AS mx, avg(y) AS my FROM pt),
z AS (SELECT doc_id, x - mx AS x, y - my AS y FROM pt, zs)"""


def _md(ledoit: bool) -> str:
    if ledoit:
        cov = """c0 AS (SELECT n, sxx / n AS a, sxy / n AS b, syy / n AS c, quartic FROM m),
c1 AS (SELECT *, (a + c) / 2 AS mu, a * a + 2 * b * b + c * c AS fro FROM c0),
c2 AS (SELECT *, (quartic / n - fro) / (2 * n) AS beta,
    (fro - 2 * mu * (a + c) + 2 * mu * mu) / 2 AS delta FROM c1),
c3 AS (SELECT *, CASE WHEN least(beta, delta) = 0 THEN 0 ELSE least(beta, delta) / delta END AS s FROM c2),
cv AS (SELECT (1 - s) * a + s * mu + 1e-6 AS a, (1 - s) * b AS b, (1 - s) * c + s * mu + 1e-6 AS c FROM c3)"""
    else:
        cov = "cv AS (SELECT sxx / (n - 1) + 1e-6 AS a, sxy / (n - 1) AS b, syy / (n - 1) + 1e-6 AS c FROM m)"
    return f"""m AS (SELECT count(*)::DOUBLE AS n, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy,
    sum((x * x + y * y) * (x * x + y * y)) AS quartic FROM z),
{cov},
md AS (SELECT doc_id, sqrt(greatest((c * x * x - 2 * b * x * y + a * y * y) / (a * c - b * b), 0)) AS md_score
  FROM z, cv)"""


PAIR_DISTANCE = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))"
PAIR_KNN = (
    _knn("z", "doc_id", PAIR_DISTANCE, Q.PAIR_OUTLIERS.k)
    + ",\nkn AS (SELECT id AS doc_id, avg(d) AS knn_score FROM nn GROUP BY id)"
)
FLAGGED = f"""lim AS (SELECT avg(md_score) + {Q.PAIR_OUTLIERS.e_md} * stddev_pop(md_score) AS lm,
    avg(knn_score) + {Q.PAIR_OUTLIERS.e_knn} * stddev_pop(knn_score) AS lk FROM md JOIN kn USING (doc_id)),
flag AS (SELECT doc_id, md_score, knn_score, (md_score > lm)::INT AS md_outlier,
    (knn_score > lk)::INT AS knn_outlier FROM md JOIN kn USING (doc_id), lim)"""
OUTLIERS = _with(*PAIRS, SCALED, _md(True), PAIR_KNN, FLAGGED)


def _flags_out(function: str) -> str:
    return (
        "SELECT doc_id, round(md_score, 6) AS md_score, round(knn_score, 6) AS knn_score, md_outlier, "
        f"knn_outlier, {function}(md_outlier, knn_outlier) AS combined_outlier FROM flag"
    )


TRIAL_ROWS = ", ".join(
    f"({i}, {t.e_md}::DOUBLE, {t.e_knn}::DOUBLE, {t.k}, '{t.combine}', '{t.knn_score}')"
    for i, t in enumerate(Q.TRIALS)
)
TRIALS = [
    *PAIRS, SCALED, _md(True), _knn("z", "doc_id", PAIR_DISTANCE, max(t.k for t in Q.TRIALS)),
    f"tr AS (SELECT * FROM (VALUES {TRIAL_ROWS}) v(trial_number, e_md, e_knn, k, combine, knn_score))",
    """sc AS (SELECT trial_number, id AS doc_id, CASE WHEN any_value(knn_score) = 'kth_distance'
    THEN max(d) ELSE avg(d) END AS knn FROM nn JOIN tr ON r <= k GROUP BY trial_number, id),
al AS (SELECT trial_number, doc_id, knn, md_score, e_md, e_knn, combine FROM sc JOIN md USING (doc_id)
    JOIN tr USING (trial_number)),
fl AS (SELECT trial_number, doc_id, combine,
    (md_score > avg(md_score) OVER t + e_md * stddev_pop(md_score) OVER t)::INT AS md_outlier,
    (knn > avg(knn) OVER t + e_knn * stddev_pop(knn) OVER t)::INT AS knn_outlier
    FROM al WINDOW t AS (PARTITION BY trial_number)),
masks AS (SELECT doc_id, trial_number, md_outlier, knn_outlier, CASE WHEN combine = 'union'
    THEN greatest(md_outlier, knn_outlier) ELSE least(md_outlier, knn_outlier) END AS combined_outlier
    FROM fl)""",
]
TRIAL_LOG = [
    *TRIALS,
    """judged AS (SELECT trial_number, 1 - quality AS y_true, combined_outlier AS y_pred
    FROM masks JOIN labels USING (doc_id)),
log AS (SELECT tr.*, acc AS mean_acc, f1 AS mean_f1 FROM tr JOIN (
    SELECT trial_number, avg((y_true = y_pred)::INT) AS acc,
      coalesce(2.0::DOUBLE * sum(y_true * y_pred) / nullif(sum(y_true) + sum(y_pred), 0), 0) AS f1
    FROM judged GROUP BY trial_number) USING (trial_number))""",
]

# --- metrics ----------------------------------------------------------------------------------

PREDICTIONS = "p AS (SELECT quality AS y_true, 1 - toxic AS y_pred FROM labels)"
GENERATIONS = """g AS (SELECT conv_id, turn, (turn % 2)::INT AS y_true,
    nullif(regexp_extract(text || CASE WHEN conv_id % 3 < 2 THEN (conv_id % 3)::VARCHAR ELSE '' END,
        '[01]'), '')::INT AS y_pred FROM conversations),
p AS (SELECT y_true, coalesce(y_pred, 1 - y_true) AS y_pred FROM g)"""
METRICS = """SELECT {extra} round(avg((y_true = y_pred)::INT), 6) AS accuracy,
  round(coalesce(2.0::DOUBLE * sum(y_true * y_pred) / nullif(sum(y_true) + sum(y_pred), 0), 0), 6) AS f1,
  round(coalesce(1.0::DOUBLE * sum(y_true * y_pred) / nullif(sum(y_pred), 0), 0), 6) AS precision,
  round(coalesce(1.0::DOUBLE * sum(y_true * y_pred) / nullif(sum(y_true), 0), 0), 6) AS recall FROM p"""
REPORT = """spine AS (SELECT * FROM (VALUES (0), (1)) s(k)),
per AS (SELECT k, sum((y_pred = k AND y_true = k)::INT)::DOUBLE AS hit, sum((y_true = k)::INT) AS support,
    sum((y_pred = k)::INT) AS said FROM spine, p GROUP BY k),
cls AS (SELECT k, support, coalesce(hit / nullif(said, 0), 0) AS pr, coalesce(hit / nullif(support, 0), 0) AS re,
    coalesce(2 * hit / nullif(said + support, 0), 0) AS f FROM per WHERE said + support > 0),
rep AS (
  SELECT k::VARCHAR AS name, pr, re, f, support FROM cls
  UNION ALL SELECT 'accuracy', NULL, NULL, avg((y_true = y_pred)::INT), count(*) FROM p
  UNION ALL SELECT 'macro avg', avg(pr), avg(re), avg(f), sum(support) FROM cls
  UNION ALL SELECT 'weighted avg', sum(pr * support) / sum(support), sum(re * support) / sum(support),
    sum(f * support) / sum(support), sum(support) FROM cls)
SELECT name, round(pr, 4)::DOUBLE AS precision, round(re, 4)::DOUBLE AS recall,
  round(f, 4)::DOUBLE AS f1_score, support::BIGINT AS support FROM rep"""
LIMIT_ROWS = ", ".join(f"({i}, {v})" for i, v in enumerate(Q.LENGTH_LIMITS))
def _newton(steps: int = 15) -> str:
    """The squared-hinge SVM on (x, y, 1) by full Newton steps, each a 3 x 3 solve by Cramer's rule."""
    costs = ", ".join(f"({c}::DOUBLE)" for c in Q.SVM_COSTS)
    parts = [
        *PAIRS[:3], "all_pt AS (SELECT doc_id, avg_word_len AS x, unique_word_ratio AS y FROM styled)",
        "pt AS (SELECT doc_id, x, y, 2 * quality - 1 AS s FROM all_pt JOIN labels USING (doc_id))",
        SCALED, "d AS (SELECT z.x, z.y, s FROM z JOIN pt USING (doc_id))",
        f"w0 AS (SELECT c, 0.0::DOUBLE AS wx, 0.0::DOUBLE AS wy, 0.0::DOUBLE AS wb FROM (VALUES {costs}) v(c))",
    ]
    for k in range(steps):
        parts.append(
            f"""h{k} AS (SELECT c, wx, wy, wb, 1 + 2 * c * sum(a * x * x) AS p, 2 * c * sum(a * x * y) AS q,
    2 * c * sum(a * x) AS r, 1 + 2 * c * sum(a * y * y) AS t, 2 * c * sum(a * y) AS u, 1 + 2 * c * sum(a) AS v,
    wx - 2 * c * sum(a * gap * s * x) AS gx, wy - 2 * c * sum(a * gap * s * y) AS gy,
    wb - 2 * c * sum(a * gap * s) AS gb
  FROM (SELECT *, 1 - s * (x * wx + y * wy + wb) AS gap, (1 - s * (x * wx + y * wy + wb) > 0)::INT AS a
    FROM d, w{k}) GROUP BY c, wx, wy, wb),
i{k} AS (SELECT *, p * (t * v - u * u) - q * (q * v - u * r) + r * (q * u - t * r) AS det FROM h{k}),
w{k + 1} AS (SELECT c,
    wx - (gx * (t * v - u * u) - q * (gy * v - u * gb) + r * (gy * u - t * gb)) / det AS wx,
    wy - (p * (gy * v - u * gb) - gx * (q * v - u * r) + r * (q * gb - gy * r)) / det AS wy,
    wb - (p * (t * gb - gy * u) - q * (q * gb - gy * r) + gx * (q * u - t * r)) / det AS wb FROM i{k})"""
        )
    return _with(*parts) + f"""SELECT c, round(any_value(wx), 5) AS wx, round(any_value(wy), 5) AS wy,
  round(any_value(wb), 5) AS b, round(avg(((x * wx + y * wy + wb > 0) = (s > 0))::INT), 5) AS accuracy
FROM d, w{steps} GROUP BY c"""


def _checks(*more: str) -> str:
    """What holds for any sound fit, from the validation rows alone."""
    also = "".join(f" UNION ALL SELECT '{m}', {v}" for m, v in (x.split("=") for x in more))
    return _with(LABELS, SPLIT_THREE, "v AS (SELECT * FROM splits WHERE split = 'val')") + f"""
SELECT 'predictions' AS property, count(*) AS value FROM v
UNION ALL SELECT 'documents', count(DISTINCT doc_id) FROM v
UNION ALL SELECT 'positives', sum(label)::BIGINT FROM v
UNION ALL SELECT 'zero_or_one', count(*) FROM v
UNION ALL SELECT 'accuracy_is_right_share', 1 UNION ALL SELECT 'beats_chance', 1{also}"""


TREE_CHECKS = ("importances_sum_to_one=1", "negative_importances=0")
STUDY_VALUES = ", ".join(f"('{SHORT_NAMES[n]}', {x})" for n, x in Q.STUDY_ROWS)
STUDY = _with(
    LABELS,
    f"""j AS (SELECT short, label AS y_true, (n_chars > lim)::INT AS y_pred FROM lab
    JOIN documents USING (doc_id), (VALUES {STUDY_VALUES}) v(short, lim))""",
    """s AS (SELECT short, avg((y_true = y_pred)::INT) AS acc,
    coalesce(2.0::DOUBLE * sum(y_true * y_pred) / nullif(sum(y_true) + sum(y_pred), 0), 0) AS f1,
    coalesce(1.0::DOUBLE * sum(y_true * y_pred) / nullif(sum(y_pred), 0), 0) AS pr,
    coalesce(1.0::DOUBLE * sum(y_true * y_pred) / nullif(sum(y_true), 0), 0) AS re
    FROM j GROUP BY short)""",
)
CV_MEAN = (
    _with(
        LABELS,
        _ranked("rk", "lab", 42),
        f"""j AS (SELECT grid_idx, lim, ((r - 1) * 5 // m) AS fold, label AS y_true, (n_chars > lim)::INT AS y_pred
    FROM rk JOIN documents USING (doc_id), (VALUES {LIMIT_ROWS}) v(grid_idx, lim))""",
        """s AS (SELECT grid_idx, lim, fold, avg((y_true = y_pred)::INT) AS acc,
    coalesce(2.0::DOUBLE * sum(y_true * y_pred) / nullif(sum(y_true) + sum(y_pred), 0), 0) AS f1
    FROM j GROUP BY 1, 2, 3)""",
    )
    + "SELECT grid_idx, lim AS \"limit\", round(avg(acc), 6) AS mean_acc, round(avg(f1), 6) AS mean_f1 "
    "FROM s GROUP BY 1, 2"
)

GENERATION = """SELECT l_linenumber AS generation, round(max(l_discount), 6) AS best_score,
  round(avg(l_discount), 6) AS mean_score,
  first(l_quantity::INT ORDER BY l_discount DESC, l_orderkey, l_partkey, l_quantity::INT) AS best_on_count
FROM lineitem GROUP BY l_linenumber"""

ORACLES: dict[str, str] = {
    "standardize_corpus": "SELECT doc_id, text, quality AS label FROM documents JOIN labels USING (doc_id)",
    "coerce_numeric": """SELECT event_id,
  CASE WHEN value IS NULL OR isnan(value) THEN 0.0 ELSE value END AS value,
  coalesce(try_cast(props AS DOUBLE), 0.0) AS props,
  coalesce(try_cast(regexp_extract(props, '[0-9]+') AS DOUBLE), 0.0) AS prop_number,
  user_id::INT AS label FROM events""",
    "align_columns": _with(DOCS, WORDS, STYLED)
    + "SELECT doc_id, word_count, char_len, quality AS label FROM styled JOIN labels USING (doc_id)",
    "drop_engineered": _with(DOCS, WORDS, STYLED)
    + """SELECT doc_id, quality AS label, ellipsis_count, parenthesis_count,
  round(avg_sentence_length_words, 6) AS avg_sentence_length_words FROM styled JOIN labels USING (doc_id)""",
    "mask_project": _with(EMB_LONG)
    + "SELECT vec_id, label, (idx // 3)::INT AS idx, round(x, 6) AS value FROM el WHERE idx % 3 = 0",
    "mask_columns": "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag AS label FROM lineitem",
    "recode_values": "SELECT o_orderkey, CASE o_orderpriority "
    + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in Q.PRIORITIES.items())
    + " ELSE o_orderpriority END AS priority FROM orders",
    "round_report": """SELECT c_custkey, round(c_acctbal / 7, 4) AS balance FROM customer
ORDER BY c_acctbal / 7 DESC, c_custkey LIMIT 40""",
    "style_features": _with(DOCS, WORDS, STYLED)
    + f"SELECT doc_id, {_round([*T.STYLE_NAMES, *T.STYLE_EXTRA_NAMES])} FROM styled",
    "readability": _with(DOCS, WORDS, READ)
    + f"""SELECT doc_id, sentence_count, syllable_count, complex_word_count,
  {_round(T.READABILITY_NAMES)} FROM readable""",
    "lexicon_sentiment": _with(DOCS, DERIVED_LEXICON, SENTIMENT) + "SELECT * FROM felt",
    "engineered_features": _with(DOCS, *ENGINEERED_PARTS, ENG)
    + f"SELECT doc_id, {_round(T.ENGINEERED_NAMES)} FROM eng",
    "term_counts": _with(DOCS, _terms(WORD_TERMS))
    + "SELECT term, count(DISTINCT doc_id) AS df, count(*) AS tf_total FROM terms GROUP BY term",
    "tfidf_vocab": _with(DOCS, _terms(WORD_TERMS), WORD_FIT) + VOCAB_OUT,
    "tfidf_fallback_vocab": _with(
        "docs AS (SELECT item_id AS doc_id, text AS t FROM benchmark)",
        CHAR_TERMS,
        _fit(ALL_DOCS, "0.5 * n", "1.0 * n", 120),
    )
    + VOCAB_OUT,
    "tfidf_word_rows": _with(DOCS, _terms(WORD_TERMS), WORD_FIT, WEIGHTS) + ROWS_OUT,
    "tfidf_bigram_rows": _with(
        DOCS, BIGRAMS, _fit(ALL_DOCS, "0.01 * n", "0.9 * n", 150), WEIGHTS
    )
    + ROWS_OUT,
    "tfidf_char_rows": _with(DOCS, CHAR_TERMS, _fit(ALL_DOCS, "2", "1.0 * n", 100), WEIGHTS) + ROWS_OUT,
    "top_terms_per_doc": _with(DOCS, _terms(WORD_TERMS), WORD_FIT, WEIGHTS)
    + """SELECT doc_id, rank::INT AS rank, term, round(value, 6) AS value FROM (SELECT *,
  row_number() OVER (PARTITION BY doc_id ORDER BY value DESC, idx) AS rank FROM weights) WHERE rank <= 5""",
    "feature_long": FEATURE_LONG,
    "feature_wide": FEATURE_WIDE,
    "column_moments": _with(EMB_LONG)
    + """SELECT idx::INT AS idx, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std
FROM el GROUP BY idx""",
    "scale_columns": _with(EMB_LONG)
    + """SELECT vec_id, idx::INT AS idx, round((x - m) / CASE WHEN s = 0 THEN 1 ELSE s END, 6) AS value
FROM el JOIN (SELECT idx, avg(x) AS m, stddev_pop(x) AS s FROM el GROUP BY idx) USING (idx)""",
    "covariance_matrix": _with(EMB_LONG, COV)
    + """SELECT i::INT AS i, j::INT AS j,
  round(g / ((SELECT count(*) FROM emb) - 1), 6) AS value FROM cov""",
    "ledoit_wolf_covariance": _with(EMB_LONG, COV, LEDOIT)
    + """SELECT i::INT AS i, j::INT AS j,
  round((1 - s) * g / n + CASE WHEN i = j THEN s * mu ELSE 0 END, 6) AS value FROM cov, sh""",
    "knn_avg": _with(EMB, _knn("emb", "vec_id", EUCLID, 10))
    + "SELECT id AS vec_id, round(avg(d), 6) AS knn_score FROM nn GROUP BY id",
    "knn_kth": _with(EMB, _knn("emb", "vec_id", EUCLID, 5))
    + "SELECT id AS vec_id, round(max(d), 6) AS knn_score FROM nn GROUP BY id",
    "knn_manhattan": _with(EMB, _knn("emb", "vec_id", MANHATTAN, 3))
    + "SELECT id AS vec_id, round(avg(d), 6) AS knn_score FROM nn GROUP BY id",
    "sigma_flags": _with(
        EMB, _knn("emb", "vec_id", EUCLID, 10), "s AS (SELECT id, avg(d) AS v FROM nn GROUP BY id)"
    )
    + """SELECT id AS vec_id, round(v, 6) AS knn_score,
  (v > (SELECT avg(v) + 1.5 * stddev_pop(v) FROM s))::INT AS knn_outlier FROM s""",
    "mahalanobis_ledoit": _with(*PAIRS, CENTRED, _md(True))
    + "SELECT doc_id, round(md_score, 6) AS md_score FROM md",
    "mahalanobis_empirical": _with(*PAIRS, CENTRED, _md(False))
    + "SELECT doc_id, round(md_score, 6) AS md_score FROM md",
    "outlier_scores": OUTLIERS + _flags_out("least"),
    "outlier_union": OUTLIERS + _flags_out("greatest"),
    "outlier_cleaned": OUTLIERS
    + """SELECT doc_id, round(md_score, 6) AS md_score, round(knn_score, 6) AS knn_score FROM flag
WHERE greatest(md_outlier, knn_outlier) = 0""",
    "outlier_removed": OUTLIERS + "SELECT doc_id FROM flag WHERE greatest(md_outlier, knn_outlier) = 1",
    "outlier_counts": OUTLIERS
    + """SELECT count(*) AS total_rows, sum(greatest(md_outlier, knn_outlier))::BIGINT AS total_removed,
  sum(1 - greatest(md_outlier, knn_outlier))::BIGINT AS total_kept FROM flag""",
    "trial_masks": _with(*TRIALS) + "SELECT * FROM masks",
    "best_trial": _with(*TRIAL_LOG)
    + """SELECT * REPLACE (round(mean_acc, 6) AS mean_acc, round(mean_f1, 6) AS mean_f1) FROM log
ORDER BY log.mean_acc DESC, trial_number LIMIT 1""",
    "svm_optimum": _newton(),
    "svm_checks": _checks(),
    "rbf_checks": _checks(),
    "forest_checks": _checks(*TREE_CHECKS),
    "boosted_checks": _checks(*TREE_CHECKS),
    "boosted_first_splits": """
WITH r AS (SELECT unnest([0, 1, 2]) AS feature,
    unnest([l_quantity::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE]) AS v,
    0.5::DOUBLE - (l_returnflag = 'R')::INT AS g FROM lineitem),
s AS (SELECT feature, v, sum(g) AS g, 0.25::DOUBLE * count(*) AS h FROM r GROUP BY feature, v),
c AS (SELECT feature, v, sum(g) OVER below AS gl, sum(h) OVER below AS hl,
    sum(g) OVER (PARTITION BY feature) AS g, sum(h) OVER (PARTITION BY feature) AS h
  FROM s WINDOW below AS (PARTITION BY feature ORDER BY v)),
k AS (SELECT *, gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1) AS gain
  FROM c WHERE hl >= 1 AND h - hl >= 1),
b AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, v) AS rk FROM k)
SELECT feature, v AS threshold, round(gain, 6) AS gain, round(-0.1 * gl / (hl + 1), 6) AS left_value,
  round(-0.1 * (g - gl) / (h - hl + 1), 6) AS right_value FROM b WHERE rk = 1 AND gain > 0.000001""",
    "applied_trial": _with(*TRIALS)
    + "SELECT doc_id FROM masks WHERE trial_number = 1 AND combined_outlier = 0",
    "tuning_report": _with(*TRIAL_LOG)
    + """SELECT e_md, e_knn, k, combine, knn_score, round(mean_acc, 6) AS cv_mean_acc,
  round(mean_f1, 6) AS cv_mean_f1 FROM log ORDER BY log.mean_acc DESC, trial_number LIMIT 1""",
    "guarded_clean": "SELECT doc_id, source FROM documents WHERE source = 'src3' OR n_chars <= 2000",
    "cv_table": STUDY + """SELECT short AS scenario, 'linear_svc' AS model, round(acc, 2) AS "CV Accuracy",
  round(f1, 2) AS "CV F1-Score" FROM s""",
    "test_table": STUDY + """SELECT short AS scenario, 'linear_svc' AS model, round(acc, 2) AS "Test Accuracy",
  round(f1, 2) AS "Test F1-Score", round(pr, 2) AS "Precision", round(re, 2) AS "Recall" FROM s""",
    "trials_by_combine": _with(*TRIAL_LOG)
    + "SELECT combine, trial_number, k, round(mean_acc, 6) AS mean_acc FROM log",
    "trial_box": _with(
        *TRIAL_LOG,
        """bx AS (SELECT combine, quantile_cont(mean_acc, 0.25) AS q1, quantile_cont(mean_acc, 0.5) AS q2,
    quantile_cont(mean_acc, 0.75) AS q3 FROM log GROUP BY combine)""",
    )
    + """SELECT combine, count(*) AS n_trials, round(min(mean_acc), 6) AS lowest,
  round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
  round(max(mean_acc), 6) AS highest,
  round(min(mean_acc) FILTER (mean_acc >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(mean_acc) FILTER (mean_acc <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high
FROM log JOIN bx USING (combine) GROUP BY combine""",
    "stratified_split": _with(LABELS, SPLIT_TWO) + "SELECT * FROM splits",
    "stratified_folds": _with(LABELS, _ranked("rk", "lab", 42))
    + "SELECT doc_id, label, ((r - 1) * 5 // m)::INT AS fold FROM rk",
    "label_counts": "SELECT quality AS label, count(*) AS n_rows FROM labels GROUP BY 1",
    "split_sizes": _with(LABELS, SPLIT_THREE) + "SELECT split, count(*) AS n_rows FROM splits GROUP BY 1",
    "trainval_union": _with(LABELS, SPLIT_THREE) + "SELECT * FROM splits WHERE split <> 'test'",
    "all_splits_union": _with(LABELS, SPLIT_THREE) + "SELECT * FROM splits",
    "confusion_matrix": _with(PREDICTIONS)
    + """SELECT 'true_' || k AS "row", count(*) FILTER (y_true = k AND y_pred = 0) AS pred_0,
  count(*) FILTER (y_true = k AND y_pred = 1) AS pred_1 FROM p, (VALUES (0), (1)) s(k) GROUP BY k""",
    "confusion_normalized": _with(PREDICTIONS)
    + """SELECT 'true_' || k AS "row",
  round(coalesce(count(*) FILTER (y_true = k AND y_pred = 0)::DOUBLE
    / nullif(count(*) FILTER (y_true = k), 0), 0), 6) AS pred_0,
  round(coalesce(count(*) FILTER (y_true = k AND y_pred = 1)::DOUBLE
    / nullif(count(*) FILTER (y_true = k), 0), 0), 6) AS pred_1
FROM p, (VALUES (0), (1)) s(k) GROUP BY k""",
    "binary_metrics": _with(PREDICTIONS) + METRICS.format(extra=""),
    "metrics_key_values": "UNPIVOT ("
    + _with(PREDICTIONS, "mt AS (" + METRICS.format(extra="") + ")")
    + "SELECT accuracy::VARCHAR AS accuracy, f1::VARCHAR AS f1, precision::VARCHAR AS precision, "
    "recall::VARCHAR AS recall FROM mt) ON accuracy, f1, precision, recall INTO NAME key VALUE value",
    "class_report": _with(PREDICTIONS) + ", " + REPORT,
    "cv_mean": CV_MEAN,
    "best_grid_point": f"SELECT * FROM ({CV_MEAN}) ORDER BY mean_acc DESC, grid_idx LIMIT 1",
    "generation_stats": GENERATION,
    "search_report": f"""SELECT 'accuracy' AS metric, best_score, best_on_count, 50 AS total_features
FROM ({GENERATION}) ORDER BY best_score DESC, generation LIMIT 1""",
    "top_weights": _with(
        EMB_LONG,
        """w AS (SELECT printf('dim_%02d', idx) AS feature,
    avg(x) FILTER (label >= 5) - avg(x) FILTER (label < 5) AS weight FROM el GROUP BY idx)""",
    )
    + """SELECT side, rank::INT AS rank, feature, round(weight, 6) AS weight FROM (
  SELECT 'highest' AS side, row_number() OVER (ORDER BY weight DESC, feature) AS rank, * FROM w
  UNION ALL SELECT 'lowest', row_number() OVER (ORDER BY weight, feature), * FROM w) WHERE rank <= 20""",
    "prompt_train": _prompt(
        10, 3, True, "split IN ('train', 'val')", "' ' || label", "doc_id, {prompt}, label", SPLIT_TWO
    ),
    "prompt_infer": _prompt(20, 2, False, "split = 'val'", "''", "doc_id, {prompt}", SPLIT_TWO),
    "prompt_splits": _prompt(
        20, 3, True, "true", "CASE WHEN split = 'test' THEN '' ELSE ' ' || label END",
        "doc_id, split, {prompt}, label", SPLIT_THREE,
    ),
    "generated_label": _with(GENERATIONS) + "SELECT conv_id, turn, y_pred FROM g",
    "generated_metrics": _with(GENERATIONS)
    + METRICS.format(
        extra="(SELECT count(*) FROM g) AS n_rows, "
        "(SELECT count(*) FROM g WHERE y_pred IS NULL) AS n_unreadable,"
    ),
    "generated_report": _with(GENERATIONS) + ", " + REPORT,
}
