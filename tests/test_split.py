import math

from pyspark.sql import functions as F

from tabula.operators import split


def test_exact_split_sizes_like_reference(spark):
    df = spark.range(1814).select(F.concat(F.lit("INN"), F.col("id").cast("string")).alias("Booking_ID"), "id")
    flagged = split.exact_split(df, "Booking_ID", 0.2, 42)
    train, test = split.train_test(flagged)
    assert test.count() == 363 and train.count() == 1451
    assert train.columns == test.columns == df.columns
    assert train.join(test, "Booking_ID", "inner").count() == 0
    assert train.unionByName(test).distinct().count() == 1814
    s = split.split_summary(flagged, "Booking_ID").first()
    assert (s.n_total, s.n_train, s.n_test, s.n_ids_both_sides) == (1814, 1451, 363, 0)


def test_exact_split_deterministic_with_duplicates(spark):
    base = spark.range(500).withColumn("k", F.col("id") % 10)
    dup = base.unionByName(base.where("id < 100"))  # repeated keys
    a = split.exact_split(dup, "id", 0.3, 1)
    b = split.exact_split(dup, "id", 0.3, 1)
    n = dup.count()
    assert a.where("is_test").count() == math.ceil(0.3 * n)
    assert sorted(map(tuple, a.where("is_test").collect())) == sorted(map(tuple, b.where("is_test").collect()))


def test_exact_split_hot_identical_rows(spark):
    hot = spark.range(300).select(F.lit(7).alias("id"))  # one key, identical copies
    rest = spark.range(100, 400).select("id")
    df = hot.unionByName(rest)
    got = split.exact_split(df, "id", 0.5, 3).where("is_test").count()
    assert got == math.ceil(0.5 * 600)


def test_hash_split_stable_per_key(spark):
    df = spark.range(2000).unionByName(spark.range(2000))
    f = split.hash_split(df, "id", 0.2, 42)
    sides = f.groupBy("id").agg(F.countDistinct("is_test").alias("n"))
    assert sides.where("n > 1").count() == 0
    share = f.where("is_test").count() / 4000
    assert 0.15 < share < 0.25


def test_exact_sample_size(spark):
    df = spark.range(1000)
    assert split.exact_sample(df, "id", 0.05, 42).count() == 50


def test_exact_split_with_secondary_key(spark):
    lines = spark.range(400).select((F.col("id") % 90).alias("order"), (F.col("id") % 4).alias("line"), "id")
    flagged = split.exact_split(lines, "order", 0.25, 5, tiebreak=["line"])
    assert flagged.where("is_test").count() == 100
    again = split.exact_split(lines, "order", 0.25, 5, tiebreak=["line"])
    assert sorted(r.id for r in flagged.where("is_test").collect()) == sorted(r.id for r in again.where("is_test").collect())


def test_hash_sample_is_stable_and_close(spark):
    base = spark.range(5000)
    a = {r.id for r in split.hash_sample(base, "id", 0.1, 9).collect()}
    more = {r.id for r in split.hash_sample(spark.range(6000), "id", 0.1, 9).collect()}
    assert a <= more and 400 < len(a) < 600


def test_split_does_not_depend_on_the_order_of_rows(spark):
    import random

    rows = [(i % 3, i % 2, i // 4) for i in range(60)] * 2
    sides = set()
    for seed in range(10):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, t int, v int").repartition(1 + seed % 4)
        flagged = split.exact_split(df, "k", 0.4, 7, tiebreak=["t"])
        test = sorted(tuple(r)[:3] for r in flagged.where("is_test").collect())
        assert len(test) == 48 and sorted(tuple(r)[:3] for r in flagged.collect()) == sorted(rows)
        sides.add(tuple(test))
    assert len(sides) == 1
