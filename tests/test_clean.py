import math

import pytest
from pyspark.sql import functions as F

from tabula.operators import clean


def test_to_number_edge_tokens(spark):
    cases = {
        "1d": None, "1f": None, "1e400": None, "1_000": None, "1,000": None, "abc": None, "": None,
        "n/a": None, " 1 ": 1.0, "5.": 5.0, ".5": 0.5, "+5": 5.0, "1e3": 1000.0, "inf": None, "nan": None,
        "-2.5E-1": -0.25,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    out = dict(clean.coerce_numeric(df.withColumn("x", F.col("v")), ["x"]).collect())
    assert out == cases


def test_missing_tokens_become_null(spark):
    df = spark.createDataFrame([("NA",), ("None",), ("x",), ("#N/A",), ("",), (None,)], "v string")
    got = [r.v for r in clean.normalize_missing(df, ["v"]).collect()]
    assert got == [None, None, "x", None, None, None]


def test_fill_mean_and_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),), (10.0,), (3.0,)], "x double")
    mean = [r.x for r in clean.fill_mean(df, ["x"]).collect()]
    assert mean[2] == pytest.approx(4.0) and mean[3] == pytest.approx(4.0)
    med = [r.x for r in clean.fill_median(df, ["x"], max_collect=1, fanout=2).collect()]
    assert med[2] == 2.5 and med[3] == 2.5  # middle pair (2, 3) averaged


def test_fill_constant_and_nan(spark):
    df = spark.createDataFrame([(None, float("nan")), ("a", 1.0)], "s string, x double")
    out = clean.fill_constant(clean.nan_to_nulls(df), {"s": "None", "x": 0.0}).collect()
    assert [tuple(r) for r in out] == [("None", 0.0), ("a", 1.0)]


def test_null_counts_one_pass(spark):
    df = spark.createDataFrame([(None, float("nan"), "a"), (1, 2.0, None), (2, None, None)], "a int, b double, c string")
    got = {r.column: r.n_missing for r in clean.null_counts(df).collect()}
    assert got == {"a": 1, "b": 2, "c": 2}


def test_missing_column_raises_before_any_job(spark):
    empty = spark.createDataFrame([], "struct<>")
    with pytest.raises(KeyError):
        clean.coerce_numeric(empty, ["lead_time"])
    with pytest.raises(KeyError):
        clean.require_columns(spark.range(1), ["nope"])


def test_ids_to_string_keeps_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "id long")
    assert [r.id for r in clean.ids_to_string(df, ["id"]).collect()] == ["1", None]
    assert not math.isnan(0.0)
