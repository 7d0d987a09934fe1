"""Exact medians of every group at once, without sorting a group or holding one in a task.

All groups are searched together. Their bounds are a table (group, range, wanted rank) that is joined to the
values in every pass: Catalyst broadcasts it while it is small, and AQE splits a hot group
otherwise. A pass takes two values around the wanted rank from mergeable quantile summaries, and counts
what lies below and between them; the values between are the next range, some hundredths of the last one.
Up to ``accuracy`` values a summary is exact, and the search of that group ends. Each pass
halves the range at least, by its middle value, where the summary fails to narrow it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.session import ensure_checkpoint_dir

ACCURACY = 2_000


def group_medians(df: DataFrame, keys: list[str], col: str, accuracy: int = ACCURACY) -> DataFrame:
    """(keys, n, median) of the non-null, non-NaN values of ``col`` per group; a group without such a
    value has a null median. Null keys are groups like others."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/medians-{uuid.uuid4().hex}"
    spark, keys = df.sparkSession, list(keys)
    value = F.col(f"`{col}`").cast("double")
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)],
                     F.when(~F.isnan(value), value).alias("v"))
    # infinities are values like others; -0.0 is 0.0
    rows = rows.withColumn("v", F.when(F.col("v") == 0, F.lit(0.0)).otherwise(F.col("v")))

    def save(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    stats = save(
        rows.groupBy(*names).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "stats"
    )
    open_ = stats.where("n > 0").select(*names, "lo", "hi", F.col("n").alias("count"), F.lit(0).cast("long").alias("below"),
                                        F.expr("(n + 1) div 2").alias("rank"))
    done, turn = None, 0
    while True:
        settled = open_.where("lo = hi").select(*names, F.col("lo").alias("low"), (F.col("below") + F.col("count")).alias("upto"))
        settled = save(settled, f"done-{turn}")
        done = settled if done is None else done.unionByName(settled)
        open_ = open_.where("lo < hi")
        if open_.isEmpty():
            break
        turn += 1
        here = _with(rows, open_, names).where("v between lo and hi")
        around = F.expr(f"greatest(0D, (rank - 0.5D) / count - if(count <= {accuracy}, 0D, 2D / {accuracy}))")
        behind = F.expr(f"least(1D, (rank - 0.5D) / count + if(count <= {accuracy}, 0D, 2D / {accuracy}))")
        # percentiles take constant shares: a summary of a few hundred steps, of which each group picks its two
        grid = [i / 400 for i in range(401)]
        summary = here.groupBy(*names).agg(F.percentile_approx("v", grid, accuracy).alias("grid"))
        pivots = _with(open_, summary, names).select(
            *names, "lo", "hi", "count", "below", "rank",
            F.element_at("grid", (F.floor(around * 400) + 1).cast("int")).alias("a"),
            F.element_at("grid", (F.ceil(behind * 400) + 1).cast("int")).alias("b"),
        )
        middle = F.col("lo") / 2 + F.col("hi") / 2
        stuck = (F.col("a") == F.col("lo")) & (F.col("b") == F.col("hi"))
        pivots = pivots.withColumn("a", F.when(stuck, F.greatest("lo", F.least(middle, F.col("hi")))).otherwise(F.col("a")))
        pivots = save(pivots.withColumn("b", F.when(stuck, F.col("a")).otherwise(F.col("b"))), f"pivots-{turn}")
        counted = _with(rows, pivots, names).where("v between lo and hi")
        part = F.when(F.col("v") < F.col("a"), 0).when(F.col("v") <= F.col("b"), 1).otherwise(2)
        parts = counted.groupBy(*names, part.alias("part")).agg(F.count("v").alias("c"), F.min("v").alias("x"), F.max("v").alias("y"))
        wide = parts.groupBy(*names).agg(
            *[F.max(F.when(F.col("part") == i, F.struct("c", "x", "y"))).alias(f"p{i}") for i in range(3)]
        )
        found = _with(pivots.select(*names, "below", "rank"), wide, names)
        c0, c1 = F.coalesce("p0.c", F.lit(0)), F.coalesce("p1.c", F.lit(0))
        pick = F.when(F.col("rank") <= c0, F.struct(F.col("p0").alias("p"), F.lit(0).cast("long").alias("s")))
        pick = pick.when(F.col("rank") <= c0 + c1, F.struct(F.col("p1").alias("p"), c0.alias("s"))).otherwise(
            F.struct(F.col("p2").alias("p"), (c0 + c1).alias("s"))
        )
        open_ = save(
            found.withColumn("pick", pick).select(
                *names, F.col("pick.p.x").alias("lo"), F.col("pick.p.y").alias("hi"), F.col("pick.p.c").alias("count"),
                (F.col("below") + F.col("pick.s")).alias("below"), (F.col("rank") - F.col("pick.s")).alias("rank"),
            ),
            f"open-{turn}",
        )
    lower = save(done, "lower")
    # even counts whose upper middle value is another one: the smallest value above the lower one
    both = _with(lower, stats.select(*names, "n"), names)
    need = both.where("n % 2 = 0 and upto < n div 2 + 1").select(*names, "low")
    upper = _with(rows, need, names).where("v > low").groupBy(*names).agg(F.min("v").alias("high"))
    made = _with(_with(stats.select(*names, "n"), lower, names, "left"), upper, names, "left")
    median = F.when(F.col("high").isNull() | (F.col("high") == F.col("low")), F.col("low")).otherwise((F.col("low") + F.col("high")) / 2)
    return made.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "n", median.alias("median"))


def _with(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on the group columns, those of the left side kept."""
    own = right.select(*[F.col(n).alias(f"_r{n}") for n in names], *[c for c in right.columns if c not in names])
    same = F.lit(True)
    for n in names:
        same = same & left[n].eqNullSafe(own[f"_r{n}"])
    return left.join(own, same, how).drop(*[f"_r{n}" for n in names])
