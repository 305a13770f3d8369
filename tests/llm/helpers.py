"""Rows and plain versions shared by the tests of the training-data operators."""

import random
import re

from pyspark.sql import Row

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as extra columns they must not disturb.
CLASHING = ["n", "cls", "token", "digest", "key", "start", "end", "spans", "tag", "row", "t", "words",
            "group", "kept", "ids", "comp", "band", "part", "label", "batch", "keep"]


def words(seed, n, vocabulary=400):
    chance = random.Random(seed)
    return [f"w{chance.randrange(vocabulary)}" for _ in range(n)]


def edge_rows():
    long_text = " ".join(words(1, 30_000, 5000))
    repeated = "Once more the very same sentence stands here, and it is longer than fifty bytes."
    return [
        (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "short", "de"), (5, repeated, "en"),
        (5, repeated, "en"), (6, repeated.upper(), "en"), (7, long_text, "en"), (8, long_text, None),
        (None, "a text without a key " + repeated, "fr"), (None, None, None), (9, "é ü 漢字 😀", "fr"),
        (10, "12345 --- !!!", "en"), (11, "� \x00 a\r\nb", "en"),
    ]


def documents(spark, rows, clashing=False):
    rows = [(*r, None, None)[:2] + (r[2] if len(r) > 2 else None, "src", 0) for r in rows]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if clashing:
        from pyspark.sql import functions as F

        for name in CLASHING:
            df = df.withColumn(name, F.lit(None).cast("double"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def bag(df):
    """The rows of a result, sorted, for comparing whole results."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


__all__ = ["Row", "WORD", "LOWER", "words", "edge_rows", "documents", "empty", "bag"]
