from tabula.operators.snapshot import snapshot_diff


def test_diff_kinds_and_null_safe_compare(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0), (4, "d", None)], "k int, s string, x double")
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 9.0), (3, None, 3.0), (5, "e", 5.0), (4, "d", None)], "k int, s string, x double")
    rows = sorted((r.k, r._change_type, r.x) for r in snapshot_diff(old, new, ["k"]).collect())
    assert rows == [(2, "update_postimage", 9.0), (2, "update_preimage", 2.0), (5, "insert", 5.0)]
    gone = snapshot_diff(old, new.where("k <> 1"), ["k"]).where("_change_type = 'delete'").collect()
    assert [r.k for r in gone] == [1]


def test_hot_repeated_key_never_multiplies(spark):
    from pyspark.sql import functions as F

    old = spark.range(1000).select(F.lit(7).alias("k"), F.col("id").alias("x")).unionByName(
        spark.range(10).select((F.col("id") + 100).alias("k"), F.lit(0).cast("long").alias("x")))
    new = spark.range(1000).select(F.lit(7).alias("k"), (F.col("id") + 1).alias("x")).unionByName(
        spark.range(10).select((F.col("id") + 100).alias("k"), F.lit(0).cast("long").alias("x")))
    rows = snapshot_diff(old, new, ["k"]).collect()
    # 999 of the 1000 rows of the repeated key are on both sides; the others are one update
    assert sorted((r.k, r._change_type, r.x) for r in rows) == [(7, "update_postimage", 1000), (7, "update_preimage", 0)]


def test_no_row_of_a_repeated_key_is_lost(spark):
    make = lambda rows: spark.createDataFrame(rows, "k int, v string")
    old = make([(1, "a"), (3, "p"), (3, "q"), (3, "q"), (None, "n")])
    new = make([(1, "a"), (1, "b"), (2, "x"), (2, "y"), (3, "q"), (3, "r"), (None, "n"), (None, "n")])
    got = sorted((str(r.k), r.v, r._change_type) for r in snapshot_diff(old, new, ["k"]).collect())
    assert got == sorted([
        ("1", "b", "insert"), ("2", "x", "insert"), ("2", "y", "insert"), ("None", "n", "insert"),
        ("3", "p", "update_preimage"), ("3", "r", "update_postimage"), ("3", "q", "delete"),
    ])
