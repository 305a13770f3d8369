"""Lexicon sentiment (VADER, Hutto & Gilbert 2014) as row expressions.

The lexicon is an input table ``(token, valence)`` of bounded size.  The bundled one is a small
demonstration set; scores equal the published analyzer's only with its full lexicon.  Emoji are
scored only if the lexicon lists them as tokens.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from docsignal.functions import text as T
from docsignal.functions.batches import owners, portions
from docsignal.functions.lookup import MAX_ENTRIES, word_lookup_sql

SENTIMENT_NAMES = ["vader_pos", "vader_neu", "vader_neg", "vader_compound"]

# Published rule constants.
BOOST = 0.293
CAPS_BOOST = 0.733
NEGATION_FACTOR = -0.74
NEVER_FACTOR = 1.25
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
DAMPING = {1: 1.0, 2: 0.95, 3: 0.9}
EXCLAIM_STEP, EXCLAIM_MAX = 0.292, 4
QUESTION_STEP, QUESTION_TOP = 0.18, 0.96
NORMALIZER = 15.0
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Published word lists.
NEGATIONS = """
    aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't
    doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't
    mightn't mustn't neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt
    uhuh wasnt werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't
    wouldn't rarely seldom despite
""".split()
INTENSIFIERS = """
    absolutely amazingly awfully completely considerable considerably decidedly deeply effing
    enormous enormously entirely especially exceptional exceptionally extreme extremely fabulously
    flipping flippin frackin fracking fricking frickin frigging friggin fully fuckin fucking fuggin
    fugging greatly hella highly hugely incredible incredibly intensely major majorly more most
    particularly purely quite really remarkably so substantially thoroughly total totally
    tremendous tremendously uber unbelievably unusually utter utterly very
""".split()
DAMPENERS = """
    almost barely hardly kinda kindof kind-of less little marginal marginally occasional
    occasionally partly scarce scarcely slight slightly somewhat sorta sortof sort-of
""".split()
DAMPENER_PHRASES = ["just enough", "kind of", "sort of"]
IDIOMS = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "bus stop": 0.0,
    "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0, "beating heart": 3.1,
    "broken heart": -2.9,
}

# Demonstration lexicon: common words with published-style mean valences.
DEMO_LEXICON = {
    "amazing": 2.8, "angry": -2.3, "attack": -2.1, "awesome": 3.1, "awful": -2.0, "bad": -2.5,
    "beautiful": 2.9, "benefit": 2.0, "best": 3.2, "better": 1.9, "blame": -1.4, "broken": -2.1,
    "calm": 1.3, "care": 2.2, "cheat": -2.0, "clean": 1.7, "corrupt": -3.0, "crime": -2.5,
    "crisis": -3.1, "cruel": -2.8, "damage": -2.2, "danger": -2.4, "dead": -3.3, "death": -2.9,
    "die": -2.9, "disaster": -3.1, "easy": 1.9, "enemy": -2.5, "enjoy": 2.2, "evil": -3.4,
    "excellent": 2.7, "fail": -2.5, "fake": -2.1, "fear": -2.2, "fine": 0.8, "fraud": -2.8,
    "free": 2.3, "friend": 2.2, "fun": 2.3, "good": 1.9, "great": 3.1, "happy": 2.7,
    "hate": -2.7, "heart": 3.2, "help": 1.7, "hero": 2.6, "honest": 2.3, "hope": 1.9,
    "horrible": -2.5, "hurt": -2.4, "joy": 2.8, "kill": -3.7, "kind": 2.4, "lie": -1.6,
    "like": 1.5, "lose": -1.7, "loss": -1.3, "love": 3.2, "nice": 1.8, "no": -1.2,
    "pain": -2.3, "panic": -2.3, "peace": 2.5, "perfect": 2.7, "please": 1.3, "poor": -2.1,
    "problem": -1.7, "proud": 2.1, "rest": 0.6, "risk": -1.1, "sad": -2.1, "safe": 1.9,
    "scam": -2.7, "smart": 1.7, "strong": 2.3, "success": 2.7, "terrible": -2.1, "thanks": 1.9,
    "threat": -2.4, "true": 1.8, "trust": 2.3, "ugly": -2.3, "war": -2.9, "warm": 0.9,
    "weak": -1.9, "welcome": 2.0, "well": 1.1, "win": 2.8, "worry": -1.9, "worst": -3.1,
    "wrong": -2.1, "yeah": 1.2, "yes": 1.7, ":)": 2.0, ":(": -1.9,
}


# --- the rules, as SQL over one scored token -------------------------------------------------
#
# A hit ``h`` is a struct (i, w, v, near): position, lower-cased token, valence so far, and the tokens
# from BEFORE places before it to AFTER places behind it (NULL beyond either end), each with its
# lower-case form ``low``, whether it is upper case and whether the lexicon lists it.  _mixed says
# that some but not all tokens of the text are upper case.  Each rule gives the next valence.

BEFORE, AFTER = 3, 2

_BOOST_OF = word_lookup_sql(
    {**{w: BOOST for w in INTENSIFIERS}, **{w: -BOOST for w in DAMPENERS}}
)
_NEGATION_OF = word_lookup_sql({w: 1.0 for w in NEGATIONS})
_IDIOM_OF = word_lookup_sql(IDIOMS)


def _near(offset: int, name: str) -> str:
    """What is known of the token that many places away (NULL beyond either end)."""
    return f"get(h.near, {BEFORE + offset}).{name}"


def _at(offset: int) -> str:
    return _near(offset, "low")


def _unlisted(distance: int) -> str:
    """There is a token that many places before, and the lexicon does not list it."""
    return f"(h.i >= {distance} AND NOT {_near(-distance, 'listed')})"


def _phrase(start: int, stop: int) -> str:
    return f"array_join(slice(h.near.low, {BEFORE + start + 1}, {stop - start + 1}), ' ')"


SCORED_TOKENS = f"""
    filter(_seen.hits, h -> {_BOOST_OF("h.w")} IS NULL
        AND NOT (h.w = 'kind' AND coalesce({_at(1)}, '') = 'of'))"""

_NO = f"""
    CASE WHEN {_at(-1)} = 'no' OR {_at(-2)} = 'no'
            OR ({_at(-3)} = 'no' AND {_at(-1)} IN ('or', 'nor')) THEN h.v * {NEGATION_FACTOR}D
        WHEN h.w = 'no' AND {_near(1, 'listed')} THEN 0D ELSE h.v END"""

_LOUDER = f"CASE WHEN h.v > 0 THEN {CAPS_BOOST}D ELSE -{CAPS_BOOST}D END"

_CAPS = f"""
    CASE WHEN _mixed AND {_near(0, "upper")} THEN h.v + {_LOUDER} ELSE h.v END"""


def _booster(distance: int) -> str:
    word, boost = _at(-distance), _BOOST_OF(_at(-distance))
    shouted = f"_mixed AND {_near(-distance, 'upper')}"
    return f"""
    CASE WHEN {_unlisted(distance)} THEN h.v + coalesce(
            (CASE WHEN h.v < 0 THEN -1D ELSE 1D END * {boost}
            + CASE WHEN {shouted} THEN {_LOUDER} ELSE 0D END) * {DAMPING[distance]}D, 0D)
        ELSE h.v END"""


def _negation(distance: int) -> str:
    word = _at(-distance)
    special = {
        1: "",
        2: f"""
        WHEN {word} = 'never' AND {_at(-1)} IN ('so', 'this') THEN h.v * {NEVER_FACTOR}D
        WHEN {word} = 'without' AND {_at(-1)} = 'doubt' THEN h.v""",
        3: f"""
        WHEN ({word} = 'never' AND {_at(-2)} IN ('so', 'this')) OR {_at(-1)} IN ('so', 'this')
            THEN h.v * {NEVER_FACTOR}D
        WHEN {word} = 'without' AND ({_at(-2)} = 'doubt' OR {_at(-1)} = 'doubt') THEN h.v""",
    }[distance]
    return f"""
    CASE WHEN NOT {_unlisted(distance)} THEN h.v {special}
        WHEN {_NEGATION_OF(word)} IS NOT NULL OR contains({word}, 'n\\'t')
            THEN h.v * {NEGATION_FACTOR}D ELSE h.v END"""


# A phrase that starts with the hit outranks those that end before or at it.
_IDIOM_SPANS = [(0, 2), (0, 1), (-1, 0), (-2, 0), (-2, -1), (-3, -1), (-3, -2)]
_IDIOM = f"""
    CASE WHEN {_unlisted(3)} THEN coalesce(
        {", ".join(_IDIOM_OF(_phrase(a, b)) for a, b in _IDIOM_SPANS)}, h.v) ELSE h.v END"""

_PHRASE_LIST = ", ".join(f"'{p}'" for p in DAMPENER_PHRASES)
_PHRASE_BOOST = f"""
    CASE WHEN {_unlisted(3)} THEN h.v - {BOOST}D * (
        CAST({_phrase(-3, -2)} IN ({_PHRASE_LIST}) AS INT)
        + CAST({_phrase(-2, -1)} IN ({_PHRASE_LIST}) AS INT)) ELSE h.v END"""

_LEAST = f"""
    CASE WHEN {_unlisted(1)} AND {_at(-1)} = 'least'
            AND coalesce({_at(-2)}, '') NOT IN ('at', 'very')
        THEN h.v * {NEGATION_FACTOR}D ELSE h.v END"""

_CONTRAST = f"""
    CASE WHEN _but >= 0 AND h.i < _but THEN h.v * {BUT_BEFORE}D
        WHEN _but >= 0 AND h.i > _but THEN h.v * {BUT_AFTER}D ELSE h.v END"""

RULES = [
    _NO, _CAPS, _booster(1), _negation(1), _booster(2), _negation(2), _booster(3), _negation(3),
    _IDIOM, _PHRASE_BOOST, _LEAST, _CONTRAST,
]


def read_lexicon(lexicon: DataFrame) -> dict[str, float]:
    """Collect a ``(token, valence)`` table after checking that it is lexicon-sized."""
    rows = lexicon.select("token", F.col("valence").cast("double")).limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"lexicon has more than {MAX_ENTRIES} tokens")
    return {token: valence for token, valence in rows}


# The letters of Unicode 16, which Spark cases and Python does not before 3.14.
NEWER_LETTERS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{0x10D50 + i: 0x10D70 + i for i in range(22)},
}
NEWER_RAISED = {low: high for high, low in NEWER_LETTERS.items()}


def lowered(word: str) -> str:
    return word.lower().translate(NEWER_LETTERS)


def raised(word: str) -> str:
    return word.upper().translate(NEWER_RAISED)


def _seen(tokens: Column, lexicon: Mapping[str, float]) -> Column:
    """``(shouted, but, hits)`` of a text's tokens: how many are upper case, where the first "but" is
    (-1: nowhere) and the tokens that the lexicon lists, with those near them."""
    if len(lexicon) > MAX_ENTRIES:
        raise ValueError(f"word table has {len(lexicon)} entries, limit is {MAX_ENTRIES}")
    valences = {word: float(v) for word, v in lexicon.items()}

    def look(lists: pa.Array) -> pa.Array:
        found = [_looked_at(part, valences) for part in portions(lists)]
        return pa.concat_arrays(found) if found else _looked_at(lists, valences)

    look_at = F.arrow_udf(
        look,
        "shouted int, but int, hits array<struct<i: int, w: string, v: double, "
        "near: array<struct<low: string, upper: boolean, listed: boolean>>>>",
    )
    return look_at(tokens)


def _looked_at(lists: pa.Array, valences: Mapping[str, float]) -> pa.Array:
    doc, raw = owners(lists), lists.flatten().cast(pa.string())
    # Emoticons and other short leftovers keep their punctuation.
    bare = pc.ascii_trim(raw, PUNCTUATION)
    tokens = pc.if_else(pc.less_equal(pc.utf8_length(bare), 2), raw, bare)
    low, high = pc.ascii_lower(tokens), pc.ascii_upper(tokens)
    wide = pc.invert(pc.string_is_ascii(tokens))
    others = tokens.filter(wide).to_pylist()
    if others:
        low = pc.replace_with_mask(low, wide, pa.array([lowered(w) for w in others], pa.string()))
        high = pc.replace_with_mask(high, wide, pa.array([raised(w) for w in others], pa.string()))
    upper = pc.and_(pc.not_equal(tokens, low), pc.equal(tokens, high)).to_numpy(zero_copy_only=False)
    entry = pc.index_in(low, pa.array(list(valences), pa.string())).fill_null(-1).to_numpy()
    listed = entry >= 0
    valence = np.append(list(valences.values()), 0.0)

    ends = np.cumsum(np.bincount(doc, minlength=len(lists)))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    but = np.full(len(lists), -1)
    at = np.flatnonzero(pc.equal(low, "but").to_numpy(zero_copy_only=False))
    but[doc[at][::-1]] = (at - starts[doc[at]])[::-1]  # the first one is written last

    at = np.flatnonzero(listed)
    owner = doc[at]
    places = at[:, None] + np.arange(-BEFORE, AFTER + 1)
    beyond = ((places < starts[owner][:, None]) | (places >= ends[owner][:, None])).ravel()
    near = np.where(beyond, 0, places.ravel())
    tokens_near = pa.StructArray.from_arrays(
        [low.take(pa.array(near)), pa.array(upper[near]), pa.array(listed[near])],
        ["low", "upper", "listed"],
        mask=pa.array(beyond),
    )
    width = BEFORE + AFTER + 1
    hits = pa.StructArray.from_arrays(
        [
            pa.array(at - starts[owner], pa.int32()),
            low.take(pa.array(at)),
            pa.array(valence[entry[at]]),
            pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * width, pa.int32()), tokens_near),
        ],
        ["i", "w", "v", "near"],
    )
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lists)))])
    shouted = np.bincount(doc, upper, len(lists))
    return pa.StructArray.from_arrays(
        [
            pa.array(shouted.astype(np.int32)),
            pa.array(but, pa.int32()),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), hits),
        ],
        ["shouted", "but", "hits"],
    )


def with_sentiment(
    df: DataFrame, text_col: str = "text", lexicon: Mapping[str, float] | None = None
) -> DataFrame:
    """Append the four sentiment columns; one row in, one row out, no shuffle.

    The rules run as a chain of small transforms over the few scored tokens of a document.
    """
    text = T.clean_text(F.col(text_col))
    staged = (
        df.withColumn("_raw", F.regexp_extract_all(text, F.lit(T.NON_SPACE + "+"), F.lit(0)))
        .withColumn("_seen", _seen(F.col("_raw"), DEMO_LEXICON if lexicon is None else lexicon))
        .withColumn("_but", F.col("_seen.but"))
        .withColumn("_mixed", F.expr("_seen.shouted > 0 AND _seen.shouted < size(_raw)"))
        .withColumn("_hits", F.expr(SCORED_TOKENS))
    )
    hits = "_hits"
    for rule in RULES:
        hits = f"transform({hits}, h -> named_struct('i', h.i, 'w', h.w, 'v', {rule}, 'near', h.near))"

    n_exclaim, n_question = T.literal_count(text, "!"), T.literal_count(text, "?")
    emphasis = F.least(n_exclaim, F.lit(float(EXCLAIM_MAX))) * EXCLAIM_STEP + F.when(
        n_question <= 1, 0.0
    ).when(n_question <= 3, n_question * QUESTION_STEP).otherwise(QUESTION_TOP)
    staged = staged.withColumns({"_v": F.expr(f"transform({hits}, h -> h.v)"), "_emph": emphasis})

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda acc, v: acc + v)

    staged = staged.withColumns(
        {
            "_sum": total(F.col("_v")),
            "_pos": total(F.transform(F.filter("_v", lambda v: v > 0), lambda v: v + 1)),
            "_neg": total(F.transform(F.filter("_v", lambda v: v < 0), lambda v: 1 - v)),
            "_neu": F.size("_raw") - F.size(F.filter("_v", lambda v: v != 0)),
        }
    )
    # Punctuation strengthens whichever side prevails.
    stronger = F.col("_emph")
    pos = F.col("_pos") + F.when(F.col("_pos") > F.col("_neg"), stronger).otherwise(0.0)
    neg = F.col("_neg") + F.when(F.col("_neg") > F.col("_pos"), stronger).otherwise(0.0)
    score = F.col("_sum") + F.signum("_sum") * stronger
    staged = staged.select(
        *df.columns, pos.alias("_p"), neg.alias("_n"), "_neu", score.alias("_s")
    )
    everything = F.col("_p") + F.col("_n") + F.col("_neu")
    shares = {"vader_pos": "_p", "vader_neu": "_neu", "vader_neg": "_n"}
    return staged.select(
        *df.columns,
        *[F.round(T.ratio(F.col(c), everything), 3).alias(name) for name, c in shares.items()],
        F.round(F.col("_s") / F.sqrt(F.col("_s") * F.col("_s") + NORMALIZER), 4).alias(
            "vader_compound"
        ),
    )
