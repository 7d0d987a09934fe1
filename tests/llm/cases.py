"""Awkward rows that every operator must take."""

from __future__ import annotations

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000
CASES = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it all", "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, "   \n\t ", "en", None, 6),
    (5, LONG, "en", "a", len(LONG)),
    (6, "The quick brown fox jumps over the lazy dog and runs away from it all", "en", "b", 1),
    (6, "The quick brown fox jumps over the lazy dog and runs away from it all", "en", "b", 1),
    (None, "no id here but some words and a few more of them", "de", "a", 3),
    (-7, "Größe ÉTÉ 中文 \U0001f600 é \x1f \u0085 x y İ ſ K", "de", "c", 9),
    (8, "12345 !!! ???", "en", "a", 13),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHES = ("id", "words", "kept", "n_words", "score", "spans", "whole", "ids", "secrets", "n_tokens", "label", "root", "_kept_id")


def awkward(spark):
    df = spark.createDataFrame(CASES, SCHEMA).repartition(3)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
