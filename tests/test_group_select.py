import math
import random
import statistics

from tabula.operators.group_select import group_medians


def check(spark, rows, accuracy):
    want = {}
    for k, v in rows:
        want.setdefault(k, []).extend([] if v is None or math.isnan(v) else [v])
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r.k: (r.n, r["median"]) for r in group_medians(df, ["k"], "v", accuracy).collect()}
    assert got == {k: (len(v), statistics.median(v) if v else None) for k, v in want.items()}


def test_medians_of_all_groups(spark):
    rng = random.Random(3)
    rows = [("hot", rng.choice([rng.gauss(0, 1), 10.0 ** rng.randrange(-300, 300), -5.0])) for _ in range(3000)]
    rows += [(f"g{rng.randrange(60)}", float(rng.randrange(40))) for _ in range(3000)]
    rows += [("one", 2.5), ("two", 1.0), ("two", 2.0), ("none", None), ("none", float("nan")), (None, 7.0), (None, 9.0), ("same", 3.0), ("same", 3.0)]
    rows += [("inf", float("inf")), ("inf", float("-inf")), ("inf", 1.0), ("wide", -1.7e308), ("wide", 1.7e308), ("wide", 0.0), ("wide", -0.0), ("wide", 5e-324)]
    check(spark, rows, 2000)
    check(spark, rows, 50)


def test_empty_and_several_keys(spark):
    assert group_medians(spark.createDataFrame([], "k string, v double"), ["k"], "v").count() == 0
    df = spark.createDataFrame([("a", 1, 5, 0), ("a", 1, 7, 0), ("a", None, 9, 0)], "k string, n int, v int, lo int")
    got = {(r[0], r[1]): (r[2], r[3]) for r in group_medians(df, ["k", "lo"], "v").collect()}
    assert got == {("a", 0): (3, 7.0)}
