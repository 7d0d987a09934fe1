"""Skew-proof ``row_number() over (partition by g order by o)``.

Groups of up to ``task_rows`` rows, counted first, are numbered by a plain window. A larger
group would be more than a task's share there, so its rows are range partitioned on (g, o)
instead, which spreads it over many partitions. Each row's position inside its
partition comes from ``monotonically_increasing_id`` right after the sort; a small table of
(g, partition) counts, one row per partition that such a group reaches, gives the offset
of every slice. The ranged rows are checkpointed so the positions used by the two
reads are the same ones. A position id is the last range key, so even rows equal on
every key (a hot tie group) are spread over partitions; each input partition is first
sorted by row content, so a re-run task assigns the same positions even when its rows
arrive in another order (identical rows are interchangeable).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.session import ensure_checkpoint_dir

#: Rows of one group that a single task numbers; larger groups are spread.
TASK_ROWS = 1_000_000
#: Names of large groups that are broadcast; more are joined by a shuffle.
MAX_BROADCAST_GROUPS = 100_000
_POS_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def _content(df: DataFrame) -> list[Column]:
    return [F.col(c) for c, t in df.dtypes if not t.startswith("map")]


def _same_group(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[f"_g_{c}"])
    return cond


def sequence_within(
    df: DataFrame,
    partition_cols: list[str],
    order_cols: list[str | Column],
    out: str = "seq",
    num_partitions: int | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``out`` = 1-based row number inside each ``partition_cols`` group.

    Rows tied on every ordering column are numbered by content; identical rows are
    interchangeable.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    number = F.row_number().over(
        Window.partitionBy(*partition_cols).orderBy(*order, F.xxhash64(*_content(df)), *_content(df))
    ).cast("long")
    if not partition_cols:
        return df.withColumn(out, number) if df.count() <= task_rows else _spread(df, [], order, out, num_partitions)
    # at most one group per task_rows rows of the table
    large = df.groupBy(*partition_cols).count().where(F.col("count") > task_rows)
    large = large.select(*[F.col(c).alias(f"_g_{c}") for c in partition_cols])
    n_large = large.count()
    if not n_large:
        return df.withColumn(out, number)
    side = F.broadcast(large) if n_large <= MAX_BROADCAST_GROUPS else large
    same = _same_group(df, large, partition_cols)
    rest = df.join(side, same, "left_anti").withColumn(out, number)
    return rest.unionByName(_spread(df.join(side, same, "left_semi"), partition_cols, order, out, num_partitions))


def _spread(df: DataFrame, partition_cols: list[str], order: list[Column], out: str, num_partitions: int | None) -> DataFrame:
    """The numbering of rows whose groups exceed a task."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in partition_cols] + order + [F.col("_tie")]
    ranged = (
        df.sortWithinPartitions(F.xxhash64(*_content(df)), *_content(df))
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn(
            "_pos",
            F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), _POS_BITS),
        )
        .checkpoint(eager=True)
    )
    slices = ranged.groupBy(*partition_cols, "_pid").agg(
        F.min("_pos").alias("_first"), F.count("*").alias("_n")
    )
    w = Window.partitionBy(*partition_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    s = slices.alias("_s")
    cond = [F.col(f"_r.{c}").eqNullSafe(F.col(f"_s.{c}")) for c in partition_cols]
    cond.append(F.col("_r._pid") == F.col("_s._pid"))
    joined = ranged.alias("_r").join(s, cond, "inner")
    seq = F.col("_s._before") + F.col("_r._pos") - F.col("_s._first") + F.lit(1)
    return joined.select("_r.*", seq.alias(out)).drop("_pid", "_pos", "_tie")
