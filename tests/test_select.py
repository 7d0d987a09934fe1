import random
import statistics

import pytest
from pyspark.sql import functions as F

from tabula.operators.select import exact_median, kth_smallest


def test_kth_matches_sorted_with_hot_value(spark):
    rnd = random.Random(1)
    vals = [rnd.randint(-1000, 1000) for _ in range(3000)] + [7] * 1500  # a third is one value
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    srt = sorted(vals)
    for k in (1, 2, 1000, 2500, 3800, len(vals)):
        r = kth_smallest(df, "v", k, fanout=8, max_collect=50)
        assert r.value == srt[k - 1]
        assert r.n_less == sum(1 for x in vals if x < r.value)
        assert r.n_equal == vals.count(r.value)


def test_kth_large_longs_and_doubles(spark):
    rnd = random.Random(2)
    big = [rnd.randrange(0, 2**60) for _ in range(2000)]
    df = spark.createDataFrame([(v, v / 3.0) for v in big], "v long, d double")
    srt = sorted(big)
    assert kth_smallest(df, "v", 1234, fanout=4, max_collect=10).value == srt[1233]
    assert kth_smallest(df, "d", 77, fanout=4, max_collect=10).value == sorted(v / 3.0 for v in big)[76]


def test_median_ignores_null_and_nan(spark):
    vals = [3.0, 1.0, None, float("nan"), 8.0, 2.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert exact_median(df, "x", max_collect=1, fanout=2) == statistics.median([3.0, 1.0, 8.0, 2.0])
    with pytest.raises(ValueError):
        kth_smallest(df, "x", 5)


def test_median_real_table(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    vals = [r[0] for r in o.select("o_totalprice").collect()]
    assert exact_median(o, "o_totalprice", max_collect=100) == statistics.median(vals)
    assert F is not None


def test_exact_medians_many_columns_shared_passes(spark):
    import random

    from tabula.operators.select import exact_medians

    rnd = random.Random(3)
    rows = [(rnd.randint(0, 50), rnd.random() * 100 if i % 9 else None, 5 if i % 3 else rnd.randint(0, 9))
            for i in range(777)]
    df = spark.createDataFrame(rows, "a long, b double, c long")
    got = exact_medians(df, ["a", "b", "c"], fanout=4, max_collect=20)
    for i, c in enumerate(["a", "b", "c"]):
        vals = [r[i] for r in rows if r[i] is not None]
        assert got[c] == statistics.median(vals), c
    assert exact_medians(df.where("a < 0"), ["a"]) == {"a": None}


def test_infinities_and_wide_spreads_take_few_passes(spark, monkeypatch):
    from pyspark.sql import DataFrame

    from tabula.operators.select import exact_medians

    rnd = random.Random(5)
    inf = float("inf")
    columns = {
        "both": [-inf, inf, inf] + [rnd.gauss(0, 1) for _ in range(2000)],
        "wide": [10.0 ** rnd.uniform(-270, 280) * rnd.choice([-1, 1]) for _ in range(2003)],
        "hot": [-inf] * 700 + [0.0, -0.0, inf] * 300 + [rnd.random() for _ in range(403)],
    }
    n = min(map(len, columns.values()))
    rows = list(zip(*(rnd.sample(v, n) for v in columns.values())))
    df = spark.createDataFrame(rows, "both double, wide double, hot double").cache()
    passes = []
    monkeypatch.setattr(DataFrame, "first", lambda self, f=DataFrame.first: passes.append(1) or f(self))
    got = exact_medians(df, list(columns), max_collect=30)
    assert len(passes) <= 10, len(passes)
    for i, c in enumerate(columns):
        assert got[c] == statistics.median(r[i] for r in rows), c
    for k in (1, 2, 700, n):
        assert kth_smallest(df, "both", k, max_collect=5).value == sorted(r[0] for r in rows)[k - 1]
        assert kth_smallest(df, "hot", k, max_collect=5, fanout=8).value == sorted(r[2] for r in rows)[k - 1]
