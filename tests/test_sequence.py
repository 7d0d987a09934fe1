import pandas as pd

from tabula.operators.sequence import sequence_within


def test_sequence_matches_row_number_with_hot_group(spark):
    rows = [("hot", i % 50, i) for i in range(900)] + [(f"g{i % 7}", i % 3, i) for i in range(300)] + [(None, 1, 5000)]
    df = spark.createDataFrame(rows, "g string, t long, k long")
    for task_rows in (100, 10_000):
        check(sequence_within(df, ["g"], ["t", "k"], num_partitions=6, task_rows=task_rows).toPandas(), rows)


def check(got, rows):
    exp = pd.DataFrame(rows, columns=["g", "t", "k"])
    exp["seq"] = exp.sort_values(["t", "k"]).groupby("g", dropna=False).cumcount() + 1
    m = got.merge(exp, on=["g", "t", "k"], suffixes=("", "_exp"), how="outer")
    assert len(m) == len(rows)
    assert (m["seq"] == m["seq_exp"]).all()


def test_global_sequence(spark):
    df = spark.createDataFrame([(v,) for v in [5, 3, 9, 1, 7]], "v long")
    got = {r.v: r.seq for r in sequence_within(df, [], ["v"], num_partitions=3).collect()}
    assert got == {1: 1, 3: 2, 5: 3, 7: 4, 9: 5}


def test_hot_tie_group_is_spread(spark):
    from pyspark.sql import functions as F

    df = spark.range(2000).select(F.lit("hot").alias("g"), F.lit(1).alias("t"), "id")
    out = sequence_within(df, ["g"], ["t"], num_partitions=8, task_rows=100)
    assert sorted(r.seq for r in out.collect()) == list(range(1, 2001))
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1  # one tie group, several partitions
