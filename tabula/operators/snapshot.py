"""Change feed between two snapshots of a keyed table, and snapshot versions.

The diff unions both snapshots with a side flag and counts equal rows once (one shuffle with
map-side combine, no join of the snapshots, so a hot key never multiplies into pairs).
What one side has more of is its surplus. A key with at most one surplus row per side, which
is every key of a table without repeated keys, is settled by one more aggregation. The
surplus rows of other keys are numbered per key and side and paired by number; numbering
is skew-proof.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.operators.sequence import sequence_within
from tabula.session import ensure_checkpoint_dir

INSERT, DELETE, PRE, POST = "insert", "delete", "update_preimage", "update_postimage"


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], change_col: str = "_change_type") -> DataFrame:
    """Rows of ``insert`` / ``delete`` / ``update_preimage`` / ``update_postimage``.

    Both snapshots must have the same columns; ``keys`` identify a row. A key may repeat:
    rows that both snapshots have (as often) are no change, and of the others the i-th old and
    the i-th new row in sorted order are an update, the rest are deletes or inserts.
    """
    values = [c for c in old.columns if c not in keys]
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("snapshots must have the same columns")
    row = F.struct(*[F.col(c) for c in values])
    both = old.select(*keys, row.alias("_row"), F.lit(-1).alias("_n")).unionByName(
        new.select(*keys, row.alias("_row"), F.lit(1).alias("_n"))
    )
    surplus = both.groupBy(*keys, "_row").agg(F.sum("_n").alias("_n")).where("_n <> 0")
    # keys that no snapshot repeats leave nothing to number; reads the keys only
    repeated = both.groupBy(*keys, "_n").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    unique = repeated.isEmpty()
    if not unique:
        # the changes alone, written once: all that follows reads them more than once
        ensure_checkpoint_dir(old.sparkSession)
        surplus = surplus.checkpoint()
    is_new, is_old = F.col("_n") > 0, F.col("_n") < 0
    per_key = surplus.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(is_old, -F.col("_n"))), F.lit(0)).alias("_n_old"),
        F.coalesce(F.sum(F.when(is_new, F.col("_n"))), F.lit(0)).alias("_n_new"),
        F.max(F.when(is_old, F.struct("_row"))).alias("_old"),
        F.max(F.when(is_new, F.struct("_row"))).alias("_new"),
    )
    pair = (F.col("_n_old") > 0) & (F.col("_n_new") > 0)
    change = lambda kind, r: F.struct(kind.alias("t"), F.col(r)["_row"].alias("r"))
    sides = F.array(
        F.when(F.col("_n_old") > 0, change(F.when(pair, PRE).otherwise(DELETE), "_old")),
        F.when(F.col("_n_new") > 0, change(F.when(pair, POST).otherwise(INSERT), "_new")),
    )
    single = (F.col("_n_old") <= 1) & (F.col("_n_new") <= 1)
    rows = per_key.where(single).select(*keys, F.explode(sides).alias("_c")).where("_c is not null")
    rows = rows.select(*keys, F.col("_c.r").alias("_row"), F.col("_c.t").alias(change_col))

    many = per_key.where(~single).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.least("_n_old", "_n_new").alias("_pairs")
    )
    out = [*keys, *[F.col(f"_row.{c}").alias(c) for c in values], change_col]
    if unique or many.isEmpty():
        return rows.select(*out)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & surplus[k].eqNullSafe(many[f"_k{i}"])
    each = surplus.join(many, same).select(
        *keys, "_row", "_pairs", is_new.alias("_is_new"), F.explode(F.sequence(F.lit(1), F.abs("_n"))).alias("_copy")
    )
    numbered = sequence_within(each, [*keys, "_is_new"], ["_row"], out="_i")
    update = F.col("_i") <= F.col("_pairs")
    kind = F.when(F.col("_is_new"), F.when(update, POST).otherwise(INSERT)).otherwise(F.when(update, PRE).otherwise(DELETE))
    rows = rows.unionByName(numbered.select(*keys, "_row", kind.alias(change_col)))
    return rows.select(*out)


def latest_versions(log: DataFrame, name_col: str = "name", version_col: str = "version") -> DataFrame:
    """Newest version per table name from a snapshot log: (name, latest_version, n_versions)."""
    return log.groupBy(name_col).agg(
        F.max(version_col).alias("latest_version"), F.countDistinct(version_col).alias("n_versions")
    )
