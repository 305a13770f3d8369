"""Per-document text signals as column expressions.

Every function takes the text column (or a word array derived from it) and returns a Column, so
one ``select`` computes all of them inside the scan stage.  NULL text counts as the empty string
and every ratio with an empty denominator is 0.0.

Tokens come from ``regexp_extract_all`` and ``regexp_count``: the regex *replace* functions are
about ten times slower on long texts.  What is asked of single words and of ASCII characters is
counted in Arrow batches (``word_counts``, ``char_counts``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from docsignal.functions.batches import owners, portions
from docsignal.functions.stopwords import ENGLISH_STOP_WORDS

# The token classes of the signals.
WORD_CHAR = "[A-Za-z']"
SPACE_CHARS = r" \t\n\x0B\f\r\x1c\x1d\x1e\x1f\x85\p{Z}"
NON_SPACE = f"[^{SPACE_CHARS}]"
PUNCTUATION = rf"[^\p{{L}}\p{{N}}_{SPACE_CHARS}]"
# "http(s)://..." or "www...." in any case; the first class rejects most characters at once.
URL = rf"[hHwW](?iu)(?:(?<=h)ttps?://|(?<=w)ww\.){NON_SPACE}+"
SENTENCE_BREAK = "[.!?]+"
TERM = r"[\p{L}\p{N}_]{2,}"
# Digits in the wide sense: decimal digits plus superscripts, subscripts and circled forms.  The
# lookahead keeps the long list away from ordinary characters.
DIGIT = (
    r"(?=[\p{Nd}\p{No}])[\p{Nd}\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}"
    r"\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}"
    r"\x{2488}-\x{2490}\x{24EA}\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}"
    r"\x{2780}-\x{2788}\x{278A}-\x{2792}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}"
    r"\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}]"
)

STYLE_NAMES = [
    "char_len", "word_count", "avg_word_len", "unique_word_ratio", "stopword_ratio",
    "punct_ratio", "uppercase_char_ratio", "uppercase_word_ratio", "digit_ratio", "url_count",
    "exclamation_count", "question_count", "comma_count", "period_count", "colon_semi_count",
    "quote_count",
]
STYLE_EXTRA_NAMES = ["ellipsis_count", "parenthesis_count", "avg_sentence_length_words"]
READABILITY_NAMES = ["flesch_reading_ease", "flesch_kincaid_grade", "gunning_fog_index"]
ENGINEERED_NAMES = STYLE_NAMES + READABILITY_NAMES + ["vader_compound"]


def clean_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def pattern_count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def literal_count(text: Column, *needles: str) -> Column:
    """Non-overlapping occurrences of each needle, by length difference (no regex)."""
    total = F.lit(0)
    for needle in needles:
        removed = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(needle), F.lit("")))
        total = total + removed / F.lit(len(needle.encode()))
    return total.cast("double")


def words(text: Column) -> Column:
    """ASCII words in order; a lone apostrophe is a word."""
    return F.regexp_extract_all(text, F.lit(WORD_CHAR + "+"), F.lit(0))


def sentence_count(text: Column) -> Column:
    """Pieces between runs of ``.!?`` that hold more than whitespace."""
    pieces = F.split(text, SENTENCE_BREAK, -1)
    return F.size(F.filter(pieces, lambda piece: piece.rlike(NON_SPACE))).cast("double")


# One match per syllable of a lower-cased word: a first consonant when the only vowel is that of a
# final "-le", the voiced "e" of such an ending, and every vowel group but a silent final one.
SYLLABLE = "^(?=[^aeiouy]+le$)[^aeiouy]|(?<=[^aeiouy]l)e$|[aeiouy]++(?!(?<=e)$)"


def syllables(lower_word: Column) -> Column:
    """Vowel groups, less a silent final ``e``, plus a voiced ``-le``; at least one."""
    return F.greatest(F.regexp_count(lower_word, F.lit(SYLLABLE)), F.lit(1))


# Classes of ASCII characters; the first three hold other characters too (``beyond_ascii``).
ASCII_SPACE = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f"
ASCII_CLASSES = {
    "punct": [c for c in map(chr, range(128)) if not (c.isalnum() or c == "_" or c in ASCII_SPACE)],
    "upper": [chr(c) for c in range(ord("A"), ord("Z") + 1)],
    "digit": list("0123456789"),
    "exclamation": ["!"],
    "question": ["?"],
    "comma": [","],
    "period": ["."],
    "colon_semi": [":", ";"],
    "quote": ['"', "'"],
    "parenthesis": ["(", ")"],
}


def beyond_ascii(text: Column) -> Column:
    """All characters but the ASCII ones, in order."""
    return F.array_join(F.regexp_extract_all(text, F.lit(r"[^\x00-\x7F]+"), F.lit(0)), "")


def char_counts(text: Column) -> Column:
    """How many characters of every ASCII class a text has."""
    member = np.array([[chr(c) in of for of in ASCII_CLASSES.values()] for c in range(128)], np.float64)
    asked = np.append(member.any(axis=1), np.zeros(128, bool))

    def count(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.string())
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        data, first = texts.buffers()[2], np.frombuffer(texts.buffers()[1], np.int32)[texts.offset]
        flat = np.frombuffer(data or b"", np.uint8)[first : first + int(lengths.sum())]
        at = np.flatnonzero(asked[flat])
        cells = np.searchsorted(ends, at, "right") * 128 + flat[at]
        sums = np.bincount(cells, minlength=len(texts) * 128).reshape(-1, 128) @ member
        return pa.StructArray.from_arrays([pa.array(c) for c in sums.T.copy()], list(ASCII_CLASSES))

    of_text = F.arrow_udf(count, ", ".join(f"{name} double" for name in ASCII_CLASSES))
    return of_text(text)


WORD_COUNTS = ["distinct", "stops", "syllables", "complex"]


def word_counts(word_array: Column) -> Column:
    """Different words (any case), stop words, syllables and words of three or more, of ASCII words."""
    stop_words, vowel = pa.array(sorted(ENGLISH_STOP_WORDS)), np.isin(np.arange(256), list(b"aeiouy"))

    def sounds_of(words: pa.Array) -> np.ndarray:
        """``syllables`` of different words, on their bytes."""
        ends, flat = (np.frombuffer(b, t) for b, t in zip(words.buffers()[1:], (np.int32, np.uint8)))
        starts, ends = ends[: len(words)], ends[1 : len(words) + 1]
        open_ = vowel[flat[: ends[-1]]]
        group = open_ & ~np.append(False, open_[:-1])
        group[starts] = open_[starts]
        groups = np.add.reduceat(group, starts, dtype=np.int64)
        silent = flat[ends - 1] == ord("e")
        voiced = silent & (ends - starts >= 3) & (flat[ends - 2] == ord("l")) & ~open_[np.maximum(ends - 3, 0)]
        return np.maximum(groups - silent + voiced + (voiced & (groups == 1)), 1)

    def count(lists: pa.Array) -> pa.Array:
        found = [np.zeros((0, len(WORD_COUNTS)))]
        for part in portions(lists):
            doc, words = owners(part), pc.ascii_lower(part.flatten()).cast(pa.string()).dictionary_encode()
            if not len(doc):
                found.append(np.zeros((len(part), len(WORD_COUNTS))))
                continue
            code, spelled = words.indices.to_numpy(), words.dictionary
            stops = pc.is_in(spelled, stop_words).to_numpy(zero_copy_only=False)
            sounds = sounds_of(spelled)
            pairs = np.sort(doc * len(spelled) + code)
            first = pairs[np.append(True, np.diff(pairs) > 0)] // len(spelled)
            sums = [
                np.bincount(first, minlength=len(part)),
                *(np.bincount(doc, of[code], len(part)) for of in (stops, sounds, sounds >= 3)),
            ]
            found.append(np.stack(sums, axis=1))
        columns = np.concatenate(found).T
        return pa.StructArray.from_arrays([pa.array(c.astype(np.float64)) for c in columns], WORD_COUNTS)

    of_words = F.arrow_udf(count, ", ".join(f"{name} double" for name in WORD_COUNTS))
    return of_words(word_array)


def style_columns(
    text: Column, word_array: Column, counts: Column, chars_of: Column, other: Column
) -> dict[str, Column]:
    """The 19 style signals; the last three are computed but not part of the engineered block.

    ``counts`` are the ``word_counts``, ``chars_of`` the ``char_counts``, ``other`` is ``beyond_ascii``.
    """
    chars = F.char_length(text).cast("double")
    n_words = F.size(word_array).cast("double")
    word_chars = F.octet_length(F.array_join(word_array, "")).cast("double")
    shouting = pattern_count(
        text, f"(?=[A-Z'])(?<!{WORD_CHAR})(?:'*+[A-Z]){{3}}[A-Z']*+(?!{WORD_CHAR})"
    )
    return {
        "char_len": chars,
        "word_count": n_words,
        "avg_word_len": ratio(word_chars, n_words),
        "unique_word_ratio": ratio(counts["distinct"], n_words),
        "stopword_ratio": ratio(counts["stops"], n_words),
        "punct_ratio": ratio(chars_of["punct"] + pattern_count(other, PUNCTUATION), chars),
        "uppercase_char_ratio": ratio(chars_of["upper"] + pattern_count(other, r"\p{Lu}"), chars),
        "uppercase_word_ratio": ratio(shouting, n_words),
        "digit_ratio": ratio(chars_of["digit"] + pattern_count(other, DIGIT), chars),
        "url_count": pattern_count(text, URL),
        "exclamation_count": chars_of["exclamation"],
        "question_count": chars_of["question"],
        "comma_count": chars_of["comma"],
        "period_count": chars_of["period"],
        "colon_semi_count": chars_of["colon_semi"],
        "quote_count": chars_of["quote"],
        "ellipsis_count": literal_count(text, "..."),
        "parenthesis_count": chars_of["parenthesis"],
        "avg_sentence_length_words": ratio(n_words, sentence_count(text)),
    }


def syllable_columns(counts: Column) -> dict[str, Column]:
    return {"syllable_count": counts["syllables"], "complex_word_count": counts["complex"]}


def readability_columns(
    n_words: Column, n_sentences: Column, n_syllables: Column, n_complex: Column
) -> dict[str, Column]:
    per_sentence = n_words / F.greatest(n_sentences, F.lit(1.0))
    per_word = ratio(n_syllables, n_words)
    return {
        "flesch_reading_ease": 206.835 - 1.015 * per_sentence - 84.6 * per_word,
        "flesch_kincaid_grade": 0.39 * per_sentence + 11.8 * per_word - 15.59,
        "gunning_fog_index": 0.4 * (per_sentence + 100.0 * ratio(n_complex, n_words)),
    }
