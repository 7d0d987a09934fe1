"""Missing data and type coercion (one ``select`` per step, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.functions.numeric import MISSING_TOKENS, nan_to_null, null_tokens, to_number
from tabula.operators.select import exact_medians

_FRACTIONAL = (T.DoubleType, T.FloatType)


class MissingColumnsError(KeyError):
    """Raised before any job when required columns are absent."""


def require_columns(df: DataFrame, cols) -> None:
    """Fail fast (driver side, no job) when any of ``cols`` is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing or not df.columns:
        raise MissingColumnsError(missing or list(cols))


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Replace or append columns in one projection, keeping the column order."""
    out = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns]
    out += [expr.alias(name) for name, expr in new.items() if name not in df.columns]
    return df.select(*out)


def normalize_missing(df: DataFrame, cols, tokens: tuple[str, ...] = MISSING_TOKENS) -> DataFrame:
    """Turn missing-value tokens in text columns into nulls."""
    return replace_columns(df, {c: null_tokens(c, tokens) for c in cols})


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Parse ``cols`` to double; unparseable or non-finite values become null."""
    require_columns(df, cols)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return replace_columns(df, {c: to_number(c, numeric=isinstance(kinds[c], T.NumericType)) for c in cols})


def nan_to_nulls(df: DataFrame, cols=None) -> DataFrame:
    """Normalise NaN to null in the given (default: all floating) columns."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, _FRACTIONAL)]
    return replace_columns(df, {c: nan_to_null(c) for c in cols})


def ids_to_string(df: DataFrame, cols) -> DataFrame:
    """Cast id columns to string; null stays null."""
    return replace_columns(df, {c: F.col(c).cast("string") for c in cols})


def column_means(df: DataFrame, cols) -> dict[str, float | None]:
    """Means of numeric columns in a single aggregation pass (one row to the driver)."""
    row = df.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def fill_mean(df: DataFrame, cols) -> DataFrame:
    """Fill missing values with the column mean (NaN counts as missing)."""
    means = column_means(df, cols)
    return replace_columns(
        df, {c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(means[c])) for c in cols}
    )


def fill_median(df: DataFrame, cols, **kw) -> DataFrame:
    """Fill missing values with the exact column median (mean of the middle pair); the
    medians of all columns come from shared passes over the data."""
    medians = exact_medians(df, cols, **kw)
    return replace_columns(
        df, {c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(medians[c])) for c in cols}
    )


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """Fill missing values with a constant per column."""
    return df.na.fill(values)


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """Missing-value count per column (null, or NaN for floats) in one pass, long form."""
    cols = list(cols or df.columns)
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, _FRACTIONAL)}
    counts = df.agg(
        *[
            F.count_if(F.col(c).isNull() | F.isnan(c) if c in floating else F.col(c).isNull()).alias(c)
            for c in cols
        ]
    )
    return counts.unpivot([], cols, "column", "n_missing")
