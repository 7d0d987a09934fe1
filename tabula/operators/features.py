"""Encoders and feature projection."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.functions.temporal import cyclic, years_since
from tabula.operators.clean import coerce_numeric, ids_to_string, replace_columns, require_columns
from tabula.operators.sequence import sequence_within
from tabula.spec import FeatureSpec

NULL_CATEGORY = "__null__"


def add_cyclic(df: DataFrame, col: str, period: float = 12.0, names=("month_as_sin", "month_as_cos")) -> DataFrame:
    """Append the sin/cos encoding of a periodic column."""
    s, c = cyclic(col, period)
    return replace_columns(df, {names[0]: s, names[1]: c})


def add_age(df: DataFrame, col: str, out: str, current_year: int | None = None, drop_source: bool = True) -> DataFrame:
    """``out = current_year - col``; the source column is dropped by default."""
    df = replace_columns(df, {out: years_since(col, current_year)})
    return df.drop(col) if drop_source else df


def project_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Ordered projection cat + num + target + ids + derived, ids cast to string."""
    require_columns(df, spec.projection)
    return ids_to_string(df.select(*spec.projection), spec.id_columns)


def feature_label_split(df: DataFrame, spec: FeatureSpec) -> tuple[DataFrame, DataFrame]:
    """(X, y): model inputs in signature order (numeric then categorical) and the target.

    Two projections of one lazy frame, so each reads only its own columns.
    """
    require_columns(df, [*spec.inputs, spec.target])
    return df.select(*spec.inputs), df.select(spec.target)


def preprocess(df: DataFrame, spec: FeatureSpec, month_col: str | None = None, period: float = 12.0) -> DataFrame:
    """Clean + feature step: coerce numerics, cyclic month, projection, id text.

    Numerics are coerced *before* the cyclic encoding so that a text month parses.
    """
    require_columns(df, spec.source_columns)
    df = coerce_numeric(df, spec.num_features)
    if month_col is not None and spec.derived:
        df = add_cyclic(df, month_col, period, names=spec.derived[:2])
    return project_features(df, spec)


@dataclass
class Dictionary:
    """Sorted distinct values of one column (neither null nor NaN) -> dense code 0..n-1."""

    column: str
    table: DataFrame  # (value, code)

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """``df`` plus the code of ``column``; missing and unseen values get -1. Catalyst picks
        a broadcast or a shuffled join from the dictionary's size."""
        out = out or f"{self.column}_code"
        table = self.table.select(F.col("value").alias("_dict_value"), F.col("code").alias("_dict_code"))
        joined = df.join(table, F.col(self.column) == F.col("_dict_value"), "left")
        return replace_columns(joined, {out: F.coalesce(F.col("_dict_code"), F.lit(-1))}).drop("_dict_value", "_dict_code")


#: Values up to which a dictionary is numbered on the driver.
SMALL_DICTIONARY = 10_000


def fit_dictionary(df: DataFrame, col: str | Column, name: str | None = None) -> Dictionary:
    """Category dictionary of a column, or of an expression over ``df`` that stands for the column
    ``name``: its distinct values, numbered in sorted order. Up to ``SMALL_DICTIONARY`` values are
    numbered on the driver, in one job; more by the sequence operator, and none of them reach the driver."""
    value = F.col(col) if isinstance(col, str) else col
    values = df.select(value.alias("value")).where(F.col("value").isNotNull())
    if isinstance(values.schema["value"].dataType, (T.DoubleType, T.FloatType)):
        values = values.where(~F.isnan("value"))
    values = values.distinct()
    some = [r[0] for r in values.limit(SMALL_DICTIONARY + 1).collect()]
    if len(some) <= SMALL_DICTIONARY:
        schema = T.StructType([values.schema["value"], T.StructField("code", T.IntegerType())])
        table = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(sorted(some))], schema)
    else:
        numbered = sequence_within(values, [], ["value"], out="code")
        table = numbered.select("value", (F.col("code") - 1).cast("int").alias("code"))
    return Dictionary(name or str(col), table)


def category_codes(df: DataFrame, cols) -> DataFrame:
    """Append ``<col>_code`` for each column: sorted-value code, missing -> -1."""
    fitted = [fit_dictionary(df, col) for col in cols]
    for dictionary in fitted:
        df = dictionary.transform(df)
    return df


def _category(col: str) -> Column:
    """Text of a category; missing is a category of its own."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(NULL_CATEGORY))


@dataclass
class OneHot:
    """Fitted one-hot encoder for columns whose categories become columns of a wide table:
    sorted categories per column (missing at fit is its own category)."""

    categories: dict[str, list[str]]

    def names(self) -> dict[tuple[str, str], str]:
        """(column, category) -> output column: ``column_category`` without characters that a column
        reference would have to quote; a name that is taken gets a number."""
        out: dict[tuple[str, str], str] = {}
        taken: set[str] = set()
        for col, vals in self.categories.items():
            for v in vals:
                base = name = re.sub(r"[.`]", "_", f"{col}_{v}")
                n = 1
                while name.lower() in taken:
                    n += 1
                    name = f"{base}__{n}"
                taken.add(name.lower())
                out[col, v] = name
        return out

    def column_names(self) -> list[str]:
        return list(self.names().values())

    def transform(self, df: DataFrame, keep_source: bool = True) -> DataFrame:
        """Add one 0/1 double column per category; unseen values give an all-zero block."""
        new = {
            name: F.when(_category(col) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)) for (col, v), name in self.names().items()
        }
        out = replace_columns(df, new)
        return out if keep_source else out.drop(*self.categories)


#: Categories of all columns together that a wide one-hot table may have.
WIDE_CATEGORIES = 10_000


def fit_one_hot(df: DataFrame, cols) -> OneHot:
    """The category set of every column, in one job (columns stacked as (column, value) rows
    inside each task). Each category becomes a column, so all of them come to the driver; more than
    ``WIDE_CATEGORIES`` are an error, and a column with so many is for ``fit_one_hot_slots``."""
    cols = list(cols)
    require_columns(df, cols)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), _category(c).alias("v")) for c in cols])).alias("_p")
    cats: dict = {c: [] for c in cols}
    found = df.select(pairs).select("_p.c", "_p.v").distinct().limit(WIDE_CATEGORIES + 1).collect()
    if len(found) > WIDE_CATEGORIES:
        raise ValueError(f"{cols} have more than {WIDE_CATEGORIES} categories")
    for r in found:
        cats[r["c"]].append(r["v"])
    return OneHot({c: sorted(vals) for c, vals in cats.items()})


@dataclass
class OneHotSlots:
    """Fitted one-hot encoder of one column with any number of categories: the block is a sparse
    struct, and the categories stay a table."""

    dictionary: Dictionary

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        """``df`` plus ``out`` = struct(size, indices, values); unseen values have no index."""
        column = self.dictionary.column
        out = out or f"{column}_slots"
        size = self.dictionary.table.agg(F.count(F.lit(1)).cast("int").alias("_size"))
        coded = Dictionary("_category", self.dictionary.table).transform(df.withColumn("_category", _category(column)), "_slot")
        seen = F.col("_slot") >= 0
        block = F.struct(
            F.col("_size").alias("size"),
            F.when(seen, F.array("_slot")).otherwise(F.array().cast("array<int>")).alias("indices"),
            F.when(seen, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
        )
        # the size is one row
        joined = coded.crossJoin(F.broadcast(size))
        return replace_columns(joined, {out: block}).drop("_category", "_slot", "_size")


def fit_one_hot_slots(df: DataFrame, col: str) -> OneHotSlots:
    """One-hot encoder of ``col`` without a limit on its categories (missing is one of them)."""
    require_columns(df, [col])
    return OneHotSlots(fit_dictionary(df, _category(col), name=col))
