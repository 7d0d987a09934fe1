"""Missing-value tokens and tolerant numeric parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default set of text tokens a CSV reader treats as missing.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: a plain decimal or scientific number with optional sign and padding.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

_INF = float("inf")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: str | Column, tokens: tuple[str, ...] = MISSING_TOKENS) -> Column:
    """Text column with every missing-value token replaced by null."""
    c = _col(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def to_number(c: str | Column, numeric: bool = False) -> Column:
    """Coerce to double: anything that is not a finite plain number becomes null.

    Mirrors "coerce" parsing: ``1d``/``1f`` suffixes, digit separators, hex and
    overflow to infinity are all missing. Output is always double. ``numeric`` says that
    the column is a number already, so that no text is made and parsed.
    """
    if numeric:
        parsed = nan_to_null(_col(c).cast("double"))
    else:
        text = _col(c).cast("string")
        parsed = F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))
    return F.when(parsed.isin(_INF, -_INF), F.lit(None).cast("double")).otherwise(parsed)


def nan_to_null(c: str | Column) -> Column:
    """Float column with NaN normalised to null."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def is_missing(c: str | Column, floating: bool = False) -> Column:
    """Null (or NaN for floating columns) predicate."""
    c = _col(c)
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()
