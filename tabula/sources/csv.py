"""CSV extracts with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.functions.numeric import MISSING_TOKENS
from tabula.operators.clean import normalize_missing


def read_csv_text(
    spark: SparkSession, path: str, columns: list[str] | None = None, tokens: tuple[str, ...] = MISSING_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Read columns as text (no inference pass), then null out missing tokens.

    Columns go by the names of the header row, wherever they stand; ``columns`` picks some of
    them in that order, and one that the header lacks is an error, as is a file whose header
    differs from the first one's. Quotes are doubled inside quoted values. A quoted line break
    needs ``multi_line`` (which keeps a file from being split over tasks); without it the
    two halves of such a row have too few values, and reading them fails.
    """
    reader = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("columnPruning", False)
    )
    header = reader.option("inferSchema", False).csv(path).columns
    absent = [c for c in columns or [] if c not in header]
    if absent:
        raise ValueError(f"{path} has no column {absent}; its header is {header}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = reader.option("mode", "FAILFAST").option("enforceSchema", False).schema(schema).csv(path)
    df = df.select(*[f"`{c}`" for c in columns or header])
    return normalize_missing(df, df.columns, tokens)


#: Column that a row which does not fit its header is kept in, whole.
REJECTED = "_rejected_row"


def read_csv_checked(
    spark: SparkSession, path: str, columns: list[str] | None = None, tokens: tuple[str, ...] = MISSING_TOKENS,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): as ``read_csv_text``, but rows with too few or too many values, or an open quote, go
    to a table of (file, row) instead of failing the scan. Every line of the files but headers and
    empty lines is in one of the two, as often as it occurs."""
    reader = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("columnPruning", False)
    )
    header = reader.option("inferSchema", False).csv(path).columns
    absent = [c for c in columns or [] if c not in header]
    if absent:
        raise ValueError(f"{path} has no column {absent}; its header is {header}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, REJECTED)])
    rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).schema(schema).csv(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    good = rows.where(F.col(REJECTED).isNull()).select(*[f"`{c}`" for c in columns or header])
    # the scan refuses to be read for the rejected row alone, so another column is asked for with it
    whole = F.coalesce(REJECTED, F.col(f"`{header[0]}`"))
    rejects = rows.where(F.col(REJECTED).isNotNull()).select(F.col("_file").alias("file"), whole.alias("row"))
    return normalize_missing(good, good.columns, tokens), rejects


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header + inferred types (an extra pass over the data; not stable across files)."""
    return spark.read.csv(path, header=True, inferSchema=True)
