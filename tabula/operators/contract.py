"""Input contracts, dataset profiles and digests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.functions.hashing import row_digest60
from tabula.operators.clean import MissingColumnsError


def capture_schema(df: DataFrame, cols=None) -> T.StructType:
    """Contract from a frame: named columns with their types, all nullable."""
    cols = list(cols or df.columns)
    by_name = {f.name: f for f in df.schema.fields}
    return T.StructType([T.StructField(c, by_name[c].dataType, True) for c in cols])


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Require every contract column, drop extras, reorder and widen safely.

    Missing names raise before any job (``to`` alone would fill them with nulls);
    unsafe casts such as text to number raise from ``to``.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise MissingColumnsError(missing)
    return df.to(schema)


def required_nulls(df: DataFrame, cols) -> DataFrame:
    """(column, n_null) for columns the contract marks required; a data check, not a type."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).unpivot([], list(cols), "column", "n_null")


def required_report(df: DataFrame, cols) -> DataFrame:
    """(column, missing, n_null) for columns that a contract requires; n_null is null for one
    that is missing."""
    there, absent = [c for c in cols if c in df.columns], [c for c in cols if c not in df.columns]
    out = df.sparkSession.createDataFrame([(c, True, None) for c in absent], "column string, missing boolean, n_null bigint")
    if there:
        out = required_nulls(df, there).select("column", F.lit(False).alias("missing"), "n_null").unionByName(out)
    return out


def profile(df: DataFrame, name: str = "dataset", digest_cols=None) -> DataFrame:
    """One row: name, num_rows, num_columns, num_elements, schema JSON; with
    ``digest_cols`` also the content digest of those columns, in the same pass."""
    ncols = len(df.columns)
    schema = json.dumps([{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields])
    aggs = [F.count("*").alias("num_rows")]
    if digest_cols is not None:
        aggs.append(_digest_sum(digest_cols).alias("digest"))
    out = df.agg(*aggs).select(
        F.lit(name).alias("name"),
        F.col("num_rows"),
        F.lit(ncols).cast("long").alias("num_columns"),
        (F.col("num_rows") * F.lit(ncols)).alias("num_elements"),
        F.lit(schema).alias("schema"),
        *(["digest"] if digest_cols is not None else []),
    )
    return out


def _digest_sum(cols):
    h = row_digest60([F.col(c) for c in cols]).cast("decimal(38,0)")
    return F.sum(h).cast("string")


def digest(df: DataFrame, cols=None) -> DataFrame:
    """Order-insensitive content digest: decimal sum of per-row 60-bit md5 prefixes.

    A sum, not a xor, so that repeated rows do not cancel; decimal so it cannot overflow.
    """
    cols = list(cols or df.columns)
    return df.agg(F.count("*").alias("num_rows"), _digest_sum(cols).alias("digest"))
