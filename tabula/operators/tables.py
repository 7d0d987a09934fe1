"""Named tables: publish, append, properties, existence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_FORMAT = "parquet"


def with_load_time(df: DataFrame, col: str = "update_timestamp_utc") -> DataFrame:
    """Append the load time (session time zone is UTC, so no shift is needed)."""
    return df.withColumn(col, F.current_timestamp())


def overwrite_table(df: DataFrame, name: str, fmt: str = DEFAULT_FORMAT, partition_by=None) -> None:
    """Replace a named table."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def append_table(df: DataFrame, name: str, keys=None, fmt: str = DEFAULT_FORMAT) -> None:
    """Append to a named table; with ``keys`` rows whose key already exists are skipped
    (null-safe left anti join against the table's keys) and of rows that share a key within
    ``df`` one is written, chosen by content, so a re-run adds nothing twice."""
    spark = df.sparkSession
    if keys:
        keys, columns = list(keys), df.columns
        rest = [F.col(f"`{c}`") for c in columns if c not in keys]
        if rest:
            one = F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("_rest")
            df = df.groupBy(*keys).agg(one).select(*keys, "_rest.*").select(*[f"`{c}`" for c in columns])
        else:
            df = df.distinct()
        if spark.catalog.tableExists(name):
            there = spark.table(name).select(*[F.col(k).alias(f"_there_{k}") for k in keys]).distinct()
            same = F.lit(True)
            for k in keys:
                same = same & df[k].eqNullSafe(there[f"_there_{k}"])
            df = df.join(there, same, "left_anti")
    df.write.mode("append").format(fmt).saveAsTable(name)


def publish_split(flagged: DataFrame, train_name: str, test_name: str, flag: str = "is_test",
                  mode: str = "overwrite", keys=None) -> None:
    """Write the train and test tables with a load timestamp, from one flagged frame. ``mode``
    ``append`` adds to them, with ``keys`` only rows whose key they do not have."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode is overwrite or append, not {mode}")
    stamped = with_load_time(flagged)
    for side, name in ((~F.col(flag), train_name), (F.col(flag), test_name)):
        rows = stamped.where(side).drop(flag)
        if mode == "append":
            append_table(rows, name, keys)
        else:
            overwrite_table(rows, name)


def set_properties(spark: SparkSession, name: str, props: dict) -> None:
    """ALTER TABLE ... SET TBLPROPERTIES."""
    body = ", ".join(f"'{k}' = '{str(v).lower() if isinstance(v, bool) else v}'" for k, v in props.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({body})")


def enable_change_feed(spark: SparkSession, *names: str) -> None:
    """Turn on the change-feed property (effective on Delta tables, recorded elsewhere)."""
    for name in names:
        set_properties(spark, name, {"delta.enableChangeDataFeed": True})


def table_properties(spark: SparkSession, name: str) -> dict:
    """SHOW TBLPROPERTIES as a dict."""
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row and no index column (a folder of part files); values keep their
    blanks, and quotes inside them are doubled."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (one document per row)."""
    df.write.mode(mode).json(path)


VERSION_LOG_DDL = "name string, version bigint, ts bigint, num_rows bigint"


def record_versions(spark: SparkSession, log_table: str, names, fmt: str = DEFAULT_FORMAT) -> dict:
    """Append the next version of each table in ``names`` (with its row count) to a
    version log in one write and return {name: version}; versions start at 0 like a
    fresh table history."""
    import time

    names = list(names)
    if not spark.catalog.tableExists(log_table):
        spark.createDataFrame([], VERSION_LOG_DDL).write.format(fmt).saveAsTable(log_table)
    tops = {
        r["name"]: r["v"]
        for r in spark.table(log_table).where(F.col("name").isin(names)).groupBy("name").agg(F.max("version").alias("v")).collect()
    }
    now = int(time.time() * 1000)
    rows = [(n, 0 if tops.get(n) is None else tops[n] + 1, now, spark.table(n).count()) for n in names]
    spark.createDataFrame(rows, VERSION_LOG_DDL).write.mode("append").format(fmt).saveAsTable(log_table)
    return {n: v for n, v, _, _ in rows}


def record_version(spark: SparkSession, log_table: str, name: str, fmt: str = DEFAULT_FORMAT) -> int:
    """Single-table form of ``record_versions``."""
    return record_versions(spark, log_table, [name], fmt)[name]


def current_version(spark: SparkSession, log_table: str, name: str) -> int | None:
    """Newest recorded version of ``name`` (None when never published)."""
    return spark.table(log_table).where(F.col("name") == name).agg(F.max("version")).first()[0]
