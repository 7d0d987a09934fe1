import pytest
from pyspark.sql import types as T

from tabula.operators import contract, decode


def test_decode_passes_unmapped(spark):
    df = spark.createDataFrame([("Not_Canceled",), ("Canceled",), ("other",), (None,)], "p string")
    got = [r.p for r in decode.decode_labels(df, "p").collect()]
    assert got == ["Room Reserved", "Room Not Reserved", "other", None]


def test_enforce_contract(spark):
    df = spark.createDataFrame([(1, "a", 2.5, "extra")], "n int, c string, d double, x string")
    schema = T.StructType([T.StructField("d", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("c", T.StringType())])
    out = contract.enforce(df, schema)
    assert out.columns == ["d", "n", "c"] and dict(out.dtypes)["n"] == "bigint"
    with pytest.raises(KeyError):
        contract.enforce(df.drop("c"), schema)
    bad = T.StructType([T.StructField("c", T.DoubleType())])
    with pytest.raises(Exception):
        contract.enforce(df, bad).collect()


def test_profile_and_digest(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    p = contract.profile(df, "t").first()
    assert (p.num_rows, p.num_columns, p.num_elements) == (3, 2, 6)
    d1 = contract.digest(df).first().digest
    d2 = contract.digest(df.orderBy("v", ascending=False)).first().digest
    d3 = contract.digest(df.distinct()).first().digest
    assert d1 == d2 and d1 != d3  # order-free, but repeated rows count
    schema = contract.capture_schema(df, ["v"])
    assert schema.fieldNames() == ["v"] and schema.fields[0].nullable


def test_required_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "a int, b string")
    assert {r.column: r.n_null for r in contract.required_nulls(df, ["a", "b"]).collect()} == {"a": 2, "b": 2}
