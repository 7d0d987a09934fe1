"""Prediction label decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The booking model's class -> display label map.
PREDICTION_LABELS = {"Not_Canceled": "Room Reserved", "Canceled": "Room Not Reserved"}


def decode_expr(c: str | Column, mapping: dict) -> Column:
    """Mapped value, or the input itself when it has no entry."""
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v)))
    return c if expr is None else expr.otherwise(c)


def decode_labels(df: DataFrame, col: str, mapping: dict | None = None, out: str | None = None) -> DataFrame:
    """Decode a label column with a map; unmapped values pass through unchanged."""
    return df.withColumn(out or col, decode_expr(col, PREDICTION_LABELS if mapping is None else mapping))
