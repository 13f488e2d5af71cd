"""Small awkward tables for the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns that the operators use as names of their own.
CLASHING = (
    "key string, size int, block int, cid string, `values` int, start int, end int, root int, kept int, copies int,"
    " path string, score int, rank int, shards int, place int, held_out int, text_key int, items int, spans int"
)

WORDS = "the quick brown fox jumps over the lazy dog and runs through seven green fields before night falls again"
LONG_TEXT = " ".join(f"word{i % 977}x{i % 31}" for i in range(150_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))

ROWS = [
    (1, WORDS, "en", "a"),
    (2, WORDS.upper(), "en", "a"),
    (3, WORDS + " one", "en", "b"),
    (4, None, "en", "a"),
    (5, "", "de", None),
    (6, "   \n\t ", None, "b"),
    (7, "12345 !!! 678", "fr", "b"),
    (8, "short", "fr", ""),
    (9, "short", "fr", "c"),
    (9, "short", "fr", "c"),
    (None, "no number here but text that has words", None, None),
    (None, None, None, None),
    (10, LONG_TEXT, "en", "d"),
    (11, "ü" * 5000, "de", "d"),
    (12, "before it " + PASSAGE + " after it", "en", "e"),
    (13, "elsewhere " + PASSAGE + " ends", "en", "e"),
    (14, "zero \0 byte, <|endoftext|> and é 　 wide", "es", "e"),
]


def documents(spark: SparkSession, rows=ROWS) -> DataFrame:
    full = [(*row, len(row[1]) if row[1] is not None else None, *([None] * CLASHING.count(","))) for row in rows]
    full = [(*row, None) for row in full]
    return spark.createDataFrame(full, f"{DOCUMENTS}, {CLASHING}").repartition(3)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{DOCUMENTS}, {CLASHING}")
