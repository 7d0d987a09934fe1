"""Frames derived from the driver tables, each with its SQL twin for the oracles.

The driver tables carry no missing or dirty values, so dirt is injected by a fixed
rule on the key (the same rule on both sides); nothing is filtered out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.functions.numeric import NUMBER_PATTERN
from tabula.functions.temporal import epoch_millis
from tabula.operators.runlog import PARENT_TAG

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_to_number(expr: str) -> str:
    """SQL twin of ``functions.numeric.to_number``."""
    parsed = f"CASE WHEN regexp_matches({expr}, '{NUMBER_PATTERN}') THEN TRY_CAST(trim({expr}) AS DOUBLE) END"
    return f"(CASE WHEN isinf({parsed}) THEN NULL ELSE {parsed} END)"


# ------------------------------------------------------------------ orders, dirtied


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with a text price and a text priority carrying missing tokens and junk."""
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("string")
    price_text = (
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .when(k % 11 == 0, F.lit("n/a"))
        .when(k % 13 == 0, F.lit("1d"))
        .when(k % 17 == 0, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(k % 19 == 0, F.lit("NaN"))
        .when(k % 23 == 0, F.lit("1e400"))
        .otherwise(price)
    )
    priority_text = (
        F.when(k % 5 == 0, F.lit("NULL"))
        .when(k % 9 == 0, F.lit(""))
        .when(k % 29 == 0, F.lit("#N/A"))
        .when(k % 31 == 0, F.lit("None"))
        .otherwise(F.col("o_orderpriority"))
    )
    return o.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderdate",
        "o_orderpriority",
        price_text.alias("price_text"),
        priority_text.alias("priority_text"),
    )


DIRTY_ORDERS_SQL = """dirty_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL
         WHEN o_orderkey % 11 = 0 THEN 'n/a'
         WHEN o_orderkey % 13 = 0 THEN '1d'
         WHEN o_orderkey % 17 = 0 THEN ' ' || CAST(o_totalprice AS VARCHAR) || ' '
         WHEN o_orderkey % 19 = 0 THEN 'NaN'
         WHEN o_orderkey % 23 = 0 THEN '1e400'
         ELSE CAST(o_totalprice AS VARCHAR) END AS price_text,
    CASE WHEN o_orderkey % 5 = 0 THEN 'NULL'
         WHEN o_orderkey % 9 = 0 THEN ''
         WHEN o_orderkey % 29 = 0 THEN '#N/A'
         WHEN o_orderkey % 31 = 0 THEN 'None'
         ELSE o_orderpriority END AS priority_text
  FROM orders)"""


def orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with o_totalprice null on some keys and NaN on others."""
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = (
        F.when(k % 7 == 0, F.lit(None).cast("double"))
        .when(k % 19 == 0, F.lit(float("nan")))
        .otherwise(F.col("o_totalprice"))
    )
    return o.select("o_orderkey", price.alias("price"))


GAPS_SQL = """gaps AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL
         WHEN o_orderkey % 19 = 0 THEN 'NaN'::DOUBLE
         ELSE o_totalprice END AS price
  FROM orders),
gaps_clean AS (
  SELECT o_orderkey, CASE WHEN isnan(price) THEN NULL ELSE price END AS price FROM gaps)"""


# ------------------------------------------------------------------ run-log shaped frames


def runs_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    run_id = F.col("o_orderkey").cast("string")
    status = (
        F.when(F.col("o_orderstatus") == "F", "FINISHED")
        .when(F.col("o_orderstatus") == "O", "RUNNING")
        .otherwise("FAILED")
    )
    start = epoch_millis("o_orderdate")
    return o.select(
        run_id.alias("run_id"),
        F.concat(F.lit("exp_"), F.col("o_orderstatus")).alias("experiment_id"),
        F.col("o_orderpriority").alias("run_name"),
        status.alias("status"),
        start.alias("start_time"),
        (start + F.lit(86_400_000)).alias("end_time"),
        F.concat(F.lit("runs:/"), run_id, F.lit("/artifacts")).alias("artifact_uri"),
        F.lit("active").alias("lifecycle_stage"),
    )


RUNS_SQL = """runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
    'exp_' || o_orderstatus AS experiment_id,
    o_orderpriority AS run_name,
    CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' WHEN o_orderstatus = 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
    (epoch_us(o_orderdate) // 1000) AS start_time,
    (epoch_us(o_orderdate) // 1000) + 86400000 AS end_time,
    'runs:/' || CAST(o_orderkey AS VARCHAR) || '/artifacts' AS artifact_uri,
    'active' AS lifecycle_stage
  FROM orders)"""


def metrics_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.concat(F.lower("l_returnflag"), F.lit("_price")).alias("key"),
        epoch_millis("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_linenumber").cast("long").alias("step"),
    )


LINE_METRICS_SQL = """line_metrics AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS run_id, lower(l_returnflag) || '_price' AS key,
    (epoch_us(l_shipdate) // 1000) AS ts, l_extendedprice AS value, CAST(l_linenumber AS BIGINT) AS step
  FROM lineitem)"""


def tags_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    run_id = F.col("o_orderkey").cast("string").alias("run_id")
    return o.select(run_id, F.lit("customer").alias("key"), F.col("o_custkey").cast("string").alias("value")).unionByName(
        o.select(run_id, F.lit("priority").alias("key"), F.col("o_orderpriority").alias("value"))
    )


TAGS_SQL = """run_tags AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'customer' AS key, CAST(o_custkey AS VARCHAR) AS value FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), 'priority', o_orderpriority FROM orders)"""


def metrics_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as metric histories: run = user, key = event type, step = day number."""
    e = load(spark, sf_dir, "events")
    ms = epoch_millis("ts")
    return e.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("key"),
        ms.alias("ts"),
        F.col("value"),
        F.floor(ms / F.lit(86_400_000)).cast("long").alias("step"),
    )


EVENT_METRICS_SQL = """event_metrics AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS key, (epoch_us(ts) // 1000) AS ts, value,
    CAST(floor((epoch_us(ts) // 1000) / 86400000) AS BIGINT) AS step
  FROM events)"""


def child_runs_from_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(runs, tags): one child run per user, parent tag ``parent_<user mod 10>``."""
    e = load(spark, sf_dir, "events")
    users = e.select("user_id").distinct()
    runs = users.select(F.col("user_id").cast("string").alias("run_id"))
    tags = users.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.lit(PARENT_TAG).alias("key"),
        F.concat(F.lit("parent_"), (F.col("user_id") % 10).cast("string")).alias("value"),
    )
    return runs, tags


def registrations_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model registrations: name per customer, created at the order date, one per order."""
    o = load(spark, sf_dir, "orders")
    run_id = F.col("o_orderkey").cast("string")
    return o.select(
        F.concat(F.lit("model_"), F.col("o_custkey").cast("string")).alias("name"),
        run_id.alias("run_id"),
        F.concat(F.lit("runs:/"), run_id, F.lit("/model")).alias("source"),
        epoch_millis("o_orderdate").alias("created"),
        F.col("o_orderkey"),
    )


REGISTRATIONS_SQL = """registrations AS (
  SELECT 'model_' || CAST(o_custkey AS VARCHAR) AS name, CAST(o_orderkey AS VARCHAR) AS run_id,
    'runs:/' || CAST(o_orderkey AS VARCHAR) || '/model' AS source, (epoch_us(o_orderdate) // 1000) AS created, o_orderkey
  FROM orders),
versions AS (
  SELECT name, run_id, source, created,
    row_number() OVER (PARTITION BY name ORDER BY created, o_orderkey) AS version, o_orderkey
  FROM registrations)"""


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined to documents; prediction = a length rule. Only ``n_chars`` is read."""
    labels = load(spark, sf_dir, "labels")
    docs = load(spark, sf_dir, "documents").select("doc_id", "n_chars")
    cls = lambda c: F.when(c == 1, F.lit("High")).otherwise(F.lit("Low"))
    return labels.join(docs, "doc_id").select(
        "doc_id",
        cls(F.col("quality")).alias("label"),
        cls((F.col("n_chars") >= 1000).cast("int")).alias("prediction"),
    )


SCORED_SQL = """scored AS (
  SELECT l.doc_id,
    CASE WHEN l.quality = 1 THEN 'High' ELSE 'Low' END AS label,
    CASE WHEN d.n_chars >= 1000 THEN 'High' ELSE 'Low' END AS prediction
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
