"""Catalog tables and generated ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A named catalog table (``db.table``; three-part names need a catalog plugin)."""
    return spark.table(name)


def row_range(spark: SparkSession, n: int) -> DataFrame:
    """Rows 0..n-1 in column ``id`` (a connectivity or smoke check source)."""
    return spark.range(n)
