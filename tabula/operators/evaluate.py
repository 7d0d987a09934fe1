"""Classification metrics computed from the confusion counts.

Only ``groupBy(label, prediction).count()`` touches the scored rows (map-side
combine, at most classes^2 groups); every metric is derived from that small table.
Zero denominators give 0, as the usual report does, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(label, prediction, n) counts."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: share of rows whose prediction equals the label."""
    return confusion(df, label, prediction).agg(
        _ratio(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)), F.sum("n")).alias(
            "accuracy"
        )
    )


def class_counts(conf: DataFrame) -> DataFrame:
    """Per class tp / fp / fn / support from a confusion table (classes seen as label or prediction).

    Each confusion row credits its label (tp or fn) and its prediction (fp), in one
    explode, so the confusion table is read once.
    """
    hit = F.col("label") == F.col("prediction")
    n = F.col("n")
    zero = F.lit(0).cast("long")
    credit = F.explode(
        F.array(
            F.struct(F.col("label").alias("class"), F.when(hit, n).otherwise(zero).alias("tp"), zero.alias("fp"),
                     F.when(hit, zero).otherwise(n).alias("fn")),
            F.struct(F.col("prediction").alias("class"), zero.alias("tp"), F.when(hit, zero).otherwise(n).alias("fp"),
                     zero.alias("fn")),
        )
    ).alias("c")
    return (
        conf.select(credit)
        .groupBy(F.col("c.class").alias("class"))
        .agg(F.sum("c.tp").alias("tp"), F.sum("c.fp").alias("fp"), F.sum("c.fn").alias("fn"))
        .withColumn("support", F.col("tp") + F.col("fn"))
    )


def per_class(conf: DataFrame) -> DataFrame:
    """Per class precision, recall, f1 and support."""
    c = class_counts(conf)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        F.col("class").cast("string").alias("class"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1_score"),
        F.col("support").cast("long").alias("support"),
        tp.alias("tp"),
    )


def _rolled(conf: DataFrame) -> DataFrame:
    """Per class rows plus one total row (``_total``) from a single rollup: macro and
    weighted averages and accuracy all come from the same linear plan."""
    pc = per_class(conf)
    s = F.col("support").cast("double")
    return pc.rollup("class").agg(
        F.grouping_id().alias("_total"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1_score").alias("f1_score"),
        _ratio(F.sum(F.col("precision") * s), F.sum(s)).alias("w_precision"),
        _ratio(F.sum(F.col("recall") * s), F.sum(s)).alias("w_recall"),
        _ratio(F.sum(F.col("f1_score") * s), F.sum(s)).alias("w_f1_score"),
        F.sum("support").cast("long").alias("support"),
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class rows plus ``macro avg`` and ``weighted avg`` rows."""
    r = _rolled(confusion(df, label, prediction))
    total = F.col("_total") == 1
    row = lambda name, p, rc, f: F.struct(
        name.alias("class"), p.alias("precision"), rc.alias("recall"), f.alias("f1_score"), F.col("support")
    )
    rows = F.when(
        total,
        F.array(
            row(F.lit("macro avg"), F.col("precision"), F.col("recall"), F.col("f1_score")),
            row(F.lit("weighted avg"), F.col("w_precision"), F.col("w_recall"), F.col("w_f1_score")),
        ),
    ).otherwise(F.array(row(F.col("class"), F.col("precision"), F.col("recall"), F.col("f1_score"))))
    return r.select(F.explode(rows).alias("r")).select("r.*")


def f1_for(df: DataFrame, label: str, prediction: str, positive) -> DataFrame:
    """One row: F1 of one named positive class (0 when the class never occurs)."""
    pc = per_class(confusion(df, label, prediction))
    hit = F.when(F.col("class") == F.lit(str(positive)), F.col("f1_score"))
    return pc.agg(F.coalesce(F.max(hit), F.lit(0.0)).alias("f1"))


def metrics_long(df: DataFrame, label: str, prediction: str, positive, f1_key: str | None = None) -> DataFrame:
    """(key, value) metric rows: accuracy, f1 of the positive class, and per class
    precision_<c>, recall_<c>, f1_<c>. Rows, not columns, so keys that differ only
    in case never collide."""
    r = _rolled(confusion(df, label, prediction))
    kv = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    cls = F.col("class")
    pos_key = F.lit(f1_key or f"f1_{str(positive).lower()}")
    rows = F.when(F.col("_total") == 1, F.array(kv(F.lit("accuracy"), F.col("accuracy")))).otherwise(
        F.array(
            kv(F.concat(F.lit("precision_"), cls), F.col("precision")),
            kv(F.concat(F.lit("recall_"), cls), F.col("recall")),
            kv(F.concat(F.lit("f1_"), cls), F.col("f1_score")),
            kv(F.when(cls == F.lit(str(positive)), pos_key), F.col("f1_score")),
        )
    )
    return r.select(F.explode(rows).alias("m")).where(F.col("m.key").isNotNull()).select("m.*")
