"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats."""

import zlib

LONG = "palabra larga y repetida " * 4000

ROWS = [
    (0, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "s"),
    (1, "the quick BROWN fox jumps over the lazy dog near the river bank today", "en", "s"),
    (2, None, None, None),
    (3, "", "en", "s"),
    (4, " \t\n ", "de", "s"),
    (5, "ein", "de", "s"),
    (6, "Der schnelle braune Fuchs springt über den faulen Hund", "de", "t"),
    (6, "Der schnelle braune Fuchs springt über den faulen Hund", "de", "t"),
    (7, LONG, "es", "s"),
    (8, "12345 67890 !!! ...", None, "s"),
    (9, "Licensed under CC BY-NC 4.0.\nsome other line  with  two blanks \n", "en", None),
    (10, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "s"),
    (None, "no id here but a text of several words in a row", "en", "s"),
    (11, "😀 smile <|endoftext|> ünïcödé a# b", "fr", "s"),
    (2, "same id as the null text", "en", "s"),
]

SCHEMA = "doc_id long, text string, lang string, source string"

#: Columns that operators make themselves; they must not clash.
CLASHING = ["score", "shard", "slot", "uid", "lf_uid", "component_id", "f0", "held_out", "cell"]


def documents(spark, rows=ROWS):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.withColumns({c: F.lit(7) for c in CLASHING})


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def multiset(rows):
    return sorted(map(tuple, rows), key=repr)
