"""Deterministic train/test splitting and fixed-size sampling.

``hash_split`` is map-only: a row is in test when the seeded md5 of its key falls
below ``ratio * 2^32``; sizes match the ratio in expectation and a key always lands
on the same side, even when rows are appended later.

``exact_split`` gives exactly ``ceil(n * ratio)`` test rows (the size rule of the
usual in-memory splitter). Rows are ranked by the seeded hash of the key and the
threshold rank is found with ``kth_smallest`` counting passes over the hashed key
alone, so no sort or shuffle of the rows is needed; the split itself is a map-only
predicate. Ties on the hash (duplicate keys) are broken by a hash of the tiebreak columns,
then of the whole row, so the order of the input plays no part; of rows that are identical
copies the right number goes to each side.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.functions.hashing import hash_fraction, hashed_key60
from tabula.operators.select import kth_smallest

_HELPERS = ("_h", "_x", "_y")


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit("\u0000"))


def hash_split(df: DataFrame, id_col: str, ratio: float = 0.2, seed: int = 42, out: str = "is_test") -> DataFrame:
    """Approximate, append-stable split flag (no shuffle, no extra pass)."""
    bound = int(ratio * 2**32)
    return df.withColumn(out, hash_fraction(_key(id_col), seed) < F.lit(bound))


def first_n_by_hash(
    df: DataFrame, id_col: str, n: int | None = None, seed: int = 42, out: str = "is_test", ratio: float | None = None,
    size_rule=None, tiebreak: list[str] | None = None,
) -> DataFrame:
    """Flag exactly ``n`` rows (or ``size_rule(rows)``, default ``ceil(ratio * rows)``):
    the first rows in seeded-hash order of ``id_col``. Rows sharing a key are ordered by
    a hash of the ``tiebreak`` columns, then of the whole row; naming a secondary key keeps
    the first of these scans to its columns.

    The hash range is known (60 bits), so the first histogram pass over the hashed key
    also counts the rows; the threshold search reads only that one column.
    """
    keyed = df.withColumn("_h", hashed_key60(_key(id_col), seed))
    if n is not None:
        rule = lambda total: n
    else:
        rule = size_rule or (lambda total: test_size(total, ratio))
    h = F.col("_h")
    r1 = kth_smallest(keyed, "_h", rule, bounds=(0, 2**60 - 1), fanout=4096)
    if r1.value is None:
        return df.withColumn(out, F.lit(r1.k >= r1.total and r1.total > 0))
    n = r1.k
    left = n - r1.n_less
    if left == r1.n_equal:
        return keyed.withColumn(out, h <= F.lit(r1.value)).drop(*_HELPERS)
    # Duplicate keys straddle the cut: order the tied rows by a hash of the tiebreak columns,
    # then by a hash of the whole row. The tied count is known, so a small tie set is
    # collected in one pass.
    pred, tied, left_over, equal = h < F.lit(r1.value), h == F.lit(r1.value), left, r1.n_equal
    steps = [list(tiebreak)] if tiebreak and set(tiebreak) != set(df.columns) else []
    for i, cols in enumerate([*steps, df.columns]):
        name = _HELPERS[1 + i]
        keyed = keyed.withColumn(name, F.xxhash64(*[F.col(f"`{c}`") for c in cols]))
        x = F.col(name)
        r = kth_smallest(keyed.where(tied), name, left_over, stats=(equal, -(2**63), 2**63 - 1))
        pred, tied = pred | (tied & (x < F.lit(r.value))), tied & (x == F.lit(r.value))
        left_over, equal = left_over - r.n_less, r.n_equal
        if left_over == equal:
            return keyed.withColumn(out, pred | tied).drop(*_HELPERS)
    # What is still tied are copies of one row (or, if hashes met, of a few): they are counted
    # and dealt out again, the first ``left_over`` of them to test. No position is needed.
    spark = df.sparkSession
    copies = keyed.where(tied).groupBy(*[F.col(f"`{c}`") for c in df.columns]).count()
    parts = [keyed.where(~tied).withColumn(out, pred).drop(*_HELPERS)]
    order = [F.col(f"`{c}`").asc_nulls_first() for c in df.columns]
    for row in copies.orderBy(*order).collect():
        n = row["count"]
        one = spark.createDataFrame([row[:-1]], df.schema)
        dealt = spark.range(n).select((F.col("id") < F.lit(left_over)).alias(out)).crossJoin(F.broadcast(one))
        parts.append(dealt.select(*[f"`{c}`" for c in df.columns], out))
        left_over -= min(n, left_over)
    flagged = parts[0]
    for part in parts[1:]:
        flagged = flagged.unionByName(part)
    return flagged


def test_size(n: int, ratio: float) -> int:
    """Size rule of the in-memory splitter: ``ceil(ratio * n)``."""
    return int(math.ceil(ratio * n))


def exact_split(
    df: DataFrame, id_col: str, ratio: float = 0.2, seed: int = 42, out: str = "is_test", tiebreak: list[str] | None = None
) -> DataFrame:
    """Flag exactly ``ceil(n * ratio)`` rows as test, deterministically from the key."""
    return first_n_by_hash(df, id_col, None, seed, out, ratio=ratio, tiebreak=tiebreak)


def exact_sample(df: DataFrame, id_col: str, frac: float, seed: int = 42) -> DataFrame:
    """Fixed-size sample without replacement: ``round(frac * n)`` rows."""
    flagged = first_n_by_hash(df, id_col, None, seed, out="_in_sample", size_rule=lambda total: int(round(frac * total)))
    return flagged.where("_in_sample").drop("_in_sample")


def hash_sample(df: DataFrame, id_col: str, frac: float, seed: int = 42) -> DataFrame:
    """Approximate sample of about ``frac`` of the rows: map-only, no count, stable when
    rows are appended (a key is either always in or always out)."""
    return hash_split(df, id_col, frac, seed, out="_in_sample").where("_in_sample").drop("_in_sample")


def train_test(flagged: DataFrame, flag: str = "is_test") -> tuple[DataFrame, DataFrame]:
    """(train, test) frames from a flagged frame; both keep the input columns."""
    return flagged.where(~F.col(flag)).drop(flag), flagged.where(F.col(flag)).drop(flag)


def split_summary(flagged: DataFrame, id_col: str, flag: str = "is_test") -> DataFrame:
    """One-row check: total, train and test sizes, ids on both sides, columns per side.

    A single grouping by id (map-side combine, so a hot id costs one row per task)
    gives every count at once.
    """
    per_id = flagged.groupBy(id_col).agg(
        F.count_if(~F.col(flag)).alias("_tr"), F.count_if(F.col(flag)).alias("_te")
    )
    return per_id.agg(
        F.sum(F.col("_tr") + F.col("_te")).alias("n_total"),
        F.sum("_tr").alias("n_train"),
        F.sum("_te").alias("n_test"),
        F.count_if((F.col("_tr") > 0) & (F.col("_te") > 0)).alias("n_ids_both_sides"),
        F.lit(len(flagged.columns) - 1).cast("long").alias("n_columns"),
    )
