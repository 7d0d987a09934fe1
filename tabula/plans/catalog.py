"""Query catalog: every operator as a query over the driver tables, with its SQL oracle.

Each Spark query calls the library operators; each SQL string states the same
result in plain SQL over the registered table views. Computed floats are rounded
to 6 places on both sides (plus 0.0 so that a negative zero reads as zero).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.functions.numeric import MISSING_TOKENS, to_number
from tabula.operators import clean, contract, decode, evaluate, features, runlog, snapshot, split
from tabula.plans import views as V
from tabula.spec import FeatureSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SEED = 42
TEST_RATIO = 0.2
SAMPLE_FRAC = 0.05
SAMPLE_SEED = 7
AGE_YEAR = 2025


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


def query(name: str, sql: str | None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ================================================================ missing data / coercion

ORDERS_TOKENS_SQL = f"""tokens AS (
  SELECT *, CASE WHEN priority_text IN ({", ".join("'" + t.replace("'", "''") + "'" for t in MISSING_TOKENS)})
             THEN NULL ELSE priority_text END AS priority
  FROM dirty_orders)"""


@query(
    "coerce_numeric",
    _with(V.DIRTY_ORDERS_SQL)
    + f"SELECT o_orderkey, price_text, {V.sql_to_number('price_text')} AS price FROM dirty_orders",
)
def q_coerce_numeric(spark, sf):
    d = V.dirty_orders(spark, sf).select("o_orderkey", "price_text", F.col("price_text").alias("price"))
    return clean.coerce_numeric(d, ["price"])


@query(
    "coerce_json_field",
    "SELECT event_id, "
    + V.sql_to_number("json_extract_string(props, '$.k')")
    + " AS k FROM events",
)
def q_coerce_json_field(spark, sf):
    e = V.load(spark, sf, "events")
    return e.select("event_id", to_number(F.get_json_object("props", "$.k")).alias("k"))


@query(
    "null_tokens",
    _with(V.DIRTY_ORDERS_SQL, ORDERS_TOKENS_SQL)
    + """SELECT o_orderstatus, count(*) AS n_rows, CAST(count_if(priority IS NULL) AS BIGINT) AS n_missing,
  CAST(count_if(priority IS NULL AND priority_text IS NOT NULL) AS BIGINT) AS n_tokens
FROM tokens GROUP BY o_orderstatus""",
)
def q_null_tokens(spark, sf):
    d = V.dirty_orders(spark, sf).withColumn("priority", F.col("priority_text"))
    d = clean.normalize_missing(d, ["priority"])
    return d.groupBy("o_orderstatus").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("priority").isNull()).alias("n_missing"),
        F.count_if(F.col("priority").isNull() & F.col("priority_text").isNotNull()).alias("n_tokens"),
    )


@query(
    "null_counts",
    _with(V.DIRTY_ORDERS_SQL, ORDERS_TOKENS_SQL)
    + f"""SELECT 'price' AS "column", CAST(count_if({V.sql_to_number('price_text')} IS NULL) AS BIGINT) AS n_missing FROM tokens
UNION ALL SELECT 'priority', CAST(count_if(priority IS NULL) AS BIGINT) FROM tokens
UNION ALL SELECT 'o_orderstatus', CAST(count_if(o_orderstatus IS NULL) AS BIGINT) FROM tokens
UNION ALL SELECT 'o_orderdate', CAST(count_if(o_orderdate IS NULL) AS BIGINT) FROM tokens""",
)
def q_null_counts(spark, sf):
    d = V.dirty_orders(spark, sf).select(
        F.col("price_text").alias("price"), F.col("priority_text").alias("priority"), "o_orderstatus", "o_orderdate"
    )
    d = clean.coerce_numeric(clean.normalize_missing(d, ["priority"]), ["price"])
    return clean.null_counts(d)


@query(
    "fill_mean",
    _with(V.GAPS_SQL)
    + "SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM gaps_clean)), 6) + 0.0 AS price FROM gaps_clean",
)
def q_fill_mean(spark, sf):
    filled = clean.fill_mean(V.orders_with_gaps(spark, sf), ["price"])
    return filled.select("o_orderkey", r6("price").alias("price"))


@query(
    "fill_median",
    _with(V.GAPS_SQL)
    + "SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM gaps_clean)), 6) + 0.0 AS price FROM gaps_clean",
)
def q_fill_median(spark, sf):
    filled = clean.fill_median(V.orders_with_gaps(spark, sf), ["price"])
    return filled.select("o_orderkey", r6("price").alias("price"))


@query(
    "fill_const",
    _with(V.DIRTY_ORDERS_SQL, ORDERS_TOKENS_SQL)
    + f"""SELECT o_orderkey, coalesce(priority, 'None') AS priority,
  coalesce({V.sql_to_number('price_text')}, 0.0) AS price FROM tokens""",
)
def q_fill_const(spark, sf):
    d = V.dirty_orders(spark, sf).select(
        "o_orderkey", F.col("priority_text").alias("priority"), F.col("price_text").alias("price")
    )
    d = clean.coerce_numeric(clean.normalize_missing(d, ["priority"]), ["price"])
    return clean.fill_constant(d, {"priority": "None", "price": 0.0})


@query(
    "nan_to_null",
    """WITH ev AS (SELECT event_id, event_type, CASE WHEN event_id % 7 = 0 THEN 'NaN'::DOUBLE ELSE value END AS value FROM events),
norm AS (SELECT event_type, value AS raw, CASE WHEN isnan(value) THEN NULL ELSE value END AS value FROM ev)
SELECT event_type, count(*) AS n_rows, CAST(count_if(value IS NULL) AS BIGINT) AS n_missing, CAST(count_if(isnan(raw)) AS BIGINT) AS n_nan,
  round(sum(value), 6) + 0.0 AS value_sum FROM norm GROUP BY event_type""",
)
def q_nan_to_null(spark, sf):
    e = V.load(spark, sf, "events")
    v = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    e = e.select("event_type", v.alias("value"), v.alias("raw"))
    e = clean.nan_to_nulls(e, ["value"])
    return e.groupBy("event_type").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.count_if(F.isnan("raw")).alias("n_nan"),
        r6(F.sum("value")).alias("value_sum"),
    )


# ================================================================ encoders / projection


@query(
    "cyclic_month",
    """SELECT o_orderkey, CAST(month(o_orderdate) AS BIGINT) AS month,
  round(sin(2.0 * pi() * month(o_orderdate) / 12.0), 6) + 0.0 AS month_sin,
  round(cos(2.0 * pi() * month(o_orderdate) / 12.0), 6) + 0.0 AS month_cos
FROM orders""",
)
def q_cyclic_month(spark, sf):
    o = V.load(spark, sf, "orders").select("o_orderkey", F.month("o_orderdate").cast("long").alias("month"))
    o = features.add_cyclic(o, "month", 12.0, names=("month_sin", "month_cos"))
    return o.select("o_orderkey", "month", r6("month_sin").alias("month_sin"), r6("month_cos").alias("month_cos"))


@query(
    "category_codes",
    """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer),
d AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT c_mktsegment FROM c WHERE c_mktsegment IS NOT NULL))
SELECT c.c_custkey, c.c_mktsegment, coalesce(d.code, -1) AS c_mktsegment_code
FROM c LEFT JOIN d ON c.c_mktsegment = d.c_mktsegment""",
)
def q_category_codes(spark, sf):
    c = V.load(spark, sf, "customer")
    seg = F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    c = c.select("c_custkey", seg.alias("c_mktsegment"))
    return features.category_codes(c, ["c_mktsegment"])


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
SCORED_EVENTS_SQL = f"""scored_events AS (
  SELECT event_id, CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 50 = 0 THEN 'refund' ELSE event_type END AS event_type
  FROM events),
fitted AS (
  SELECT DISTINCT event_type FROM events
  WHERE ('0x' || substr(md5('{SEED}:' || CAST(event_id AS VARCHAR)), 1, 8))::UBIGINT >= {int(TEST_RATIO * 2**32)})"""


def _scored_events(spark, sf):
    e = V.load(spark, sf, "events")
    t = (
        F.when(F.col("event_id") % 37 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 50 == 0, F.lit("refund"))
        .otherwise(F.col("event_type"))
    )
    return e, e.select("event_id", t.alias("event_type"))


def _fit_event_one_hot(events):
    train = split.hash_split(events, "event_id", TEST_RATIO, SEED).where(~F.col("is_test"))
    return features.fit_one_hot(train, ["event_type"])


@query(
    "one_hot_wide",
    _with(SCORED_EVENTS_SQL)
    + "SELECT event_id, "
    + ", ".join(
        f"CASE WHEN event_type = '{t}' AND '{t}' IN (SELECT event_type FROM fitted) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS event_type_{t}"
        for t in EVENT_TYPES
    )
    + " FROM scored_events",
)
def q_one_hot_wide(spark, sf):
    events, scored = _scored_events(spark, sf)
    return _fit_event_one_hot(events).transform(scored, keep_source=False)


@query(
    "one_hot_unknown",
    _with(SCORED_EVENTS_SQL)
    + """SELECT coalesce(event_type, '<null>') AS event_type, count(*) AS n_rows,
  CAST(sum(CASE WHEN event_type IN (SELECT event_type FROM fitted) THEN 1 ELSE 0 END) AS DOUBLE) AS n_hot
FROM scored_events GROUP BY 1""",
)
def q_one_hot_unknown(spark, sf):
    events, scored = _scored_events(spark, sf)
    model = _fit_event_one_hot(events)
    wide = model.transform(scored)
    block = sum((F.col(c) for c in model.column_names()), F.lit(0.0))
    return wide.groupBy(F.coalesce("event_type", F.lit("<null>")).alias("event_type")).agg(
        F.count("*").alias("n_rows"), F.sum(block).alias("n_hot")
    )


@query(
    "one_hot_many",
    f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS cust FROM orders),
fitted AS (SELECT DISTINCT coalesce(cust, '{features.NULL_CATEGORY}') AS v FROM o
  WHERE ('0x' || substr(md5('{SEED}:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::UBIGINT >= {int(TEST_RATIO * 2**32)}),
slots AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS slot FROM fitted)
SELECT o_orderkey, CAST((SELECT count(*) FROM slots) AS INTEGER) AS n_slots, slot, CASE WHEN slot IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS block_sum
FROM o LEFT JOIN slots ON v = coalesce(cust, '{features.NULL_CATEGORY}')""",
)
def q_one_hot_many(spark, sf):
    """A column with thousands of categories: fitted on the training side, all rows encoded."""
    k = F.col("o_orderkey")
    o = V.load(spark, sf, "orders").select(k, F.when(k % 41 != 0, F.col("o_custkey").cast("string")).alias("cust"))
    train = split.hash_split(o, "o_orderkey", TEST_RATIO, SEED).where(~F.col("is_test"))
    wide = features.fit_one_hot_slots(train, "cust").transform(o, out="block")
    return wide.select(
        "o_orderkey",
        F.col("block.size").alias("n_slots"),
        F.get("block.indices", F.lit(0)).alias("slot"),
        F.aggregate("block.values", F.lit(0.0), lambda a, x: a + x).alias("block_sum"),
    )


ORDERS_SPEC = FeatureSpec(
    num_features=("price", "o_custkey", "order_month"),
    cat_features=("o_orderpriority",),
    target="o_orderstatus",
    id_columns=("o_orderkey",),
    derived=("month_as_sin", "month_as_cos"),
)


def _orders_raw(spark, sf) -> DataFrame:
    """orders in the shape of a raw text extract: dirty price, text month."""
    return V.dirty_orders(spark, sf).select(
        "o_orderkey",
        "o_orderpriority",
        "o_orderstatus",
        F.col("price_text").alias("price"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.month("o_orderdate").cast("string").alias("order_month"),
    )


def _preprocessed(spark, sf) -> DataFrame:
    pre = features.preprocess(_orders_raw(spark, sf), ORDERS_SPEC, month_col="order_month")
    return pre.withColumn("month_as_sin", r6("month_as_sin")).withColumn("month_as_cos", r6("month_as_cos"))


PREPROCESS_SQL = _with(
    V.DIRTY_ORDERS_SQL,
    f"""pre AS (
  SELECT o_orderpriority, {V.sql_to_number('price_text')} AS price, CAST(o_custkey AS DOUBLE) AS o_custkey,
    CAST(month(o_orderdate) AS DOUBLE) AS order_month, o_orderstatus, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
    round(sin(2.0 * pi() * month(o_orderdate) / 12.0), 6) + 0.0 AS month_as_sin,
    round(cos(2.0 * pi() * month(o_orderdate) / 12.0), 6) + 0.0 AS month_as_cos
  FROM dirty_orders)""",
)


@query("preprocess", PREPROCESS_SQL + "SELECT * FROM pre")
def q_preprocess(spark, sf):
    return _preprocessed(spark, sf)


@query(
    "model_inputs",
    PREPROCESS_SQL + "SELECT price, o_custkey, order_month, o_orderpriority FROM pre",
)
def q_model_inputs(spark, sf):
    """Feature/label split of the cleaned frame: the model input block X (target dropped)."""
    x, _ = features.feature_label_split(_preprocessed(spark, sf), ORDERS_SPEC)
    return x


@query("targets", PREPROCESS_SQL + "SELECT o_orderstatus, count(*) AS n_rows FROM pre GROUP BY 1")
def q_targets(spark, sf):
    """The target block y of the feature/label split, counted per class."""
    _, y = features.feature_label_split(_preprocessed(spark, sf), ORDERS_SPEC)
    return y.groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"))


@query(
    "age_column",
    f"SELECT o_orderkey, o_orderstatus, CAST({AGE_YEAR} - year(o_orderdate) AS BIGINT) AS order_age FROM orders",
)
def q_age_column(spark, sf):
    o = V.load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("order_year"))
    aged = features.add_age(o, "order_year", "order_age", current_year=AGE_YEAR)
    return aged.withColumn("order_age", F.col("order_age").cast("long"))


@query(
    "label_decode",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status_label FROM orders",
)
def q_label_decode(spark, sf):
    o = V.load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return decode.decode_labels(o, "o_orderstatus", {"F": "fulfilled", "O": "open"}, out="status_label").drop(
        "o_orderstatus"
    )


# ================================================================ splitting and sampling

_MD5_ORDER = f"md5('{SEED}:' || CAST(o_orderkey AS VARCHAR)), o_orderkey"


@query(
    "hash_split",
    f"""SELECT o_orderkey,
  ('0x' || substr(md5('{SEED}:' || CAST(o_orderkey AS VARCHAR)), 1, 8))::UBIGINT < {int(TEST_RATIO * 2**32)} AS is_test
FROM orders""",
)
def q_hash_split(spark, sf):
    o = V.load(spark, sf, "orders").select("o_orderkey")
    return split.hash_split(o, "o_orderkey", TEST_RATIO, SEED)


EXACT_SPLIT_SQL = f"""ranked AS (
  SELECT *, row_number() OVER (ORDER BY {_MD5_ORDER}) AS rn, count(*) OVER () AS n FROM orders),
flagged AS (SELECT *, rn <= ceil({TEST_RATIO} * n) AS is_test FROM ranked)"""


@query("exact_split", _with(EXACT_SPLIT_SQL) + "SELECT o_orderkey, is_test FROM flagged")
def q_exact_split(spark, sf):
    o = V.load(spark, sf, "orders").select("o_orderkey")
    return split.exact_split(o, "o_orderkey", TEST_RATIO, SEED)


@query(
    "exact_sample",
    f"""WITH ranked AS (
  SELECT o_orderkey, o_totalprice,
    row_number() OVER (ORDER BY md5('{SAMPLE_SEED}:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn,
    count(*) OVER () AS n FROM orders)
SELECT o_orderkey, o_totalprice FROM ranked WHERE rn <= round({SAMPLE_FRAC} * n)""",
)
def q_exact_sample(spark, sf):
    o = V.load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return split.exact_sample(o, "o_orderkey", SAMPLE_FRAC, SAMPLE_SEED)


@query(
    "split_checks",
    _with(EXACT_SPLIT_SQL)
    + """SELECT count(*) AS n_total, CAST(count_if(NOT is_test) AS BIGINT) AS n_train, CAST(count_if(is_test) AS BIGINT) AS n_test,
  CAST((SELECT count(*) FROM (SELECT o_orderkey FROM flagged GROUP BY o_orderkey HAVING count(DISTINCT is_test) > 1)) AS BIGINT) AS n_ids_both_sides,
  CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM orders)) AS BIGINT) AS n_columns FROM flagged""",
)
def q_split_checks(spark, sf):
    o = V.load(spark, sf, "orders")
    return split.split_summary(split.exact_split(o, "o_orderkey", TEST_RATIO, SEED), "o_orderkey")


@query(
    "exact_split_dupkeys",
    f"""WITH ranked AS (
  SELECT l_orderkey, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(l_orderkey AS VARCHAR))) AS rn,
    count(*) OVER () AS n FROM lineitem)
SELECT CAST(count_if(rn <= ceil({TEST_RATIO} * n)) AS BIGINT) AS n_test,
  CAST(count_if(rn > ceil({TEST_RATIO} * n)) AS BIGINT) AS n_train,
  CAST(sum(CASE WHEN rn <= ceil({TEST_RATIO} * n) THEN l_orderkey ELSE 0 END) AS BIGINT) AS test_key_sum
FROM ranked""",
)
def q_exact_split_dupkeys(spark, sf):
    """Exact split keyed by a repeated key (about four lines per order): the size is exact
    even when the cut falls inside one order's lines; which lines of that order go to
    test does not change these sums."""
    li = V.load(spark, sf, "lineitem")
    flagged = split.exact_split(li, "l_orderkey", TEST_RATIO, SEED, tiebreak=["l_linenumber"])
    t = F.col("is_test")
    return flagged.agg(
        F.count_if(t).alias("n_test"),
        F.count_if(~t).alias("n_train"),
        F.sum(F.when(t, F.col("l_orderkey")).otherwise(F.lit(0))).alias("test_key_sum"),
    )


@query(
    "hash_split_grouped",
    f"""WITH f AS (
  SELECT l_orderkey,
    ('0x' || substr(md5('{SEED}:' || CAST(l_orderkey AS VARCHAR)), 1, 8))::UBIGINT < {int(TEST_RATIO * 2**32)} AS is_test
  FROM lineitem),
per_order AS (SELECT l_orderkey, count_if(NOT is_test) AS tr, count_if(is_test) AS te FROM f GROUP BY l_orderkey)
SELECT CAST(sum(tr + te) AS BIGINT) AS n_total, CAST(sum(tr) AS BIGINT) AS n_train, CAST(sum(te) AS BIGINT) AS n_test,
  CAST(count_if(tr > 0 AND te > 0) AS BIGINT) AS n_ids_both_sides, CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM lineitem)) AS BIGINT) AS n_columns FROM per_order""",
)
def q_hash_split_grouped(spark, sf):
    """Hash split of lines by order key: every line of an order lands on the same side."""
    li = V.load(spark, sf, "lineitem")
    return split.split_summary(split.hash_split(li, "l_orderkey", TEST_RATIO, SEED), "l_orderkey")


@query(
    "split_profile",
    PREPROCESS_SQL
    + f""", ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || o_orderkey), o_orderkey) AS rn, count(*) OVER () AS n FROM pre)
SELECT CASE WHEN rn <= ceil({TEST_RATIO} * n) THEN 'test' ELSE 'train' END AS split,
  count(*) AS n_rows, count(price) AS n_price, round(avg(price), 6) + 0.0 AS avg_price,
  round(avg(month_as_sin), 6) + 0.0 AS avg_month_sin, round(avg(month_as_cos), 6) + 0.0 AS avg_month_cos
FROM ranked GROUP BY 1""",
)
def q_split_profile(spark, sf):
    """Flagship: raw extract -> clean + features -> exact split -> per-split profile."""
    flagged = split.exact_split(_preprocessed(spark, sf), "o_orderkey", TEST_RATIO, SEED)
    side = F.when(F.col("is_test"), F.lit("test")).otherwise(F.lit("train"))
    return flagged.groupBy(side.alias("split")).agg(
        F.count("*").alias("n_rows"),
        F.count("price").alias("n_price"),
        r6(F.avg("price")).alias("avg_price"),
        r6(F.avg("month_as_sin")).alias("avg_month_sin"),
        r6(F.avg("month_as_cos")).alias("avg_month_cos"),
    )


# ================================================================ evaluation


@query("confusion", _with(V.SCORED_SQL) + "SELECT label, prediction, count(*) AS n FROM scored GROUP BY ALL")
def q_confusion(spark, sf):
    return evaluate.confusion(V.scored_documents(spark, sf), "label", "prediction")


@query(
    "accuracy",
    _with(V.SCORED_SQL) + "SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS accuracy FROM scored",
)
def q_accuracy(spark, sf):
    return evaluate.accuracy(V.scored_documents(spark, sf), "label", "prediction").select(
        r6("accuracy").alias("accuracy")
    )


CLASS_SQL = """sides AS (
  SELECT label AS class, CASE WHEN label = prediction THEN 1 ELSE 0 END AS tp, 0 AS fp,
    CASE WHEN label = prediction THEN 0 ELSE 1 END AS fn FROM scored
  UNION ALL
  SELECT prediction, 0, 1, 0 FROM scored WHERE label <> prediction),
counts AS (SELECT class, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM sides GROUP BY class),
per_class AS (
  SELECT class,
    coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1_score,
    CAST(tp + fn AS BIGINT) AS support
  FROM counts)"""


@query("f1_pos", _with(V.SCORED_SQL, CLASS_SQL) + "SELECT round(f1_score, 6) + 0.0 AS f1 FROM per_class WHERE class = 'High'")
def q_f1_pos(spark, sf):
    return evaluate.f1_for(V.scored_documents(spark, sf), "label", "prediction", "High").select(r6("f1").alias("f1"))


@query(
    "class_report",
    _with(V.SCORED_SQL, CLASS_SQL)
    + """, report AS (
  SELECT class, precision, recall, f1_score, support FROM per_class
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class)
SELECT class, round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall,
  round(f1_score, 6) + 0.0 AS f1_score, support FROM report""",
)
def q_class_report(spark, sf):
    rep = evaluate.class_report(V.scored_documents(spark, sf), "label", "prediction")
    return rep.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1_score").alias("f1_score"), "support")


@query(
    "metrics_long",
    _with(V.SCORED_SQL, CLASS_SQL)
    + """, m AS (
  SELECT 'accuracy' AS key, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS value FROM scored
  UNION ALL SELECT 'f1_high', f1_score FROM per_class WHERE class = 'High'
  UNION ALL SELECT 'precision_' || class, precision FROM per_class
  UNION ALL SELECT 'recall_' || class, recall FROM per_class
  UNION ALL SELECT 'f1_' || class, f1_score FROM per_class)
SELECT key, round(value, 6) + 0.0 AS value FROM m""",
)
def q_metrics_long(spark, sf):
    m = evaluate.metrics_long(V.scored_documents(spark, sf), "label", "prediction", "High")
    return m.select("key", r6("value").alias("value"))


# ================================================================ contracts, profiles, digests


@query(
    "contract_project",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_returnflag FROM lineitem""",
)
def q_contract_project(spark, sf):
    from pyspark.sql import types as T

    schema = T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_linenumber", T.LongType()),
            T.StructField("l_quantity", T.DoubleType()),
            T.StructField("l_returnflag", T.StringType()),
        ]
    )
    return contract.enforce(V.load(spark, sf, "lineitem"), schema)


@query(
    "contract_required",
    _with(V.DIRTY_ORDERS_SQL)
    + """, required AS (SELECT unnest(['o_orderkey', 'o_orderstatus', 'price_text', 'discount', 'channel']) AS "column"),
there AS (SELECT column_name AS "column" FROM (DESCRIBE WITH """
    + V.DIRTY_ORDERS_SQL
    + """ SELECT * FROM dirty_orders)),
nulls AS (
  SELECT 'o_orderkey' AS "column", count_if(o_orderkey IS NULL) AS n_null FROM dirty_orders
  UNION ALL SELECT 'o_orderstatus', count_if(o_orderstatus IS NULL) FROM dirty_orders
  UNION ALL SELECT 'price_text', count_if(price_text IS NULL) FROM dirty_orders)
SELECT r."column", r."column" NOT IN (SELECT "column" FROM there) AS missing, CAST(n_null AS BIGINT) AS n_null
FROM required r LEFT JOIN nulls n ON r."column" = n."column" """,
)
def q_contract_required(spark, sf):
    """Columns that a contract requires: those that are missing, and the nulls of the others."""
    return contract.required_report(V.dirty_orders(spark, sf), ["o_orderkey", "o_orderstatus", "price_text", "discount", "channel"])


@query(
    "dataset_profile",
    PREPROCESS_SQL
    + f""", width AS (SELECT count(*) AS n FROM (DESCRIBE {PREPROCESS_SQL}SELECT * FROM pre))
SELECT 'orders_clean' AS name, count(*) AS num_rows, any_value(n) AS num_columns, count(*) * any_value(n) AS num_elements FROM pre, width""",
)
def q_dataset_profile(spark, sf):
    return contract.profile(_preprocessed(spark, sf), "orders_clean").drop("schema")


_DIGEST_PARTS = [
    "CAST(o_orderkey AS VARCHAR)",
    "CAST(o_custkey AS VARCHAR)",
    "o_orderstatus",
    "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)",
    "o_orderpriority",
    "CAST(o_orderdate AS VARCHAR)",
]


@query(
    "dataset_digest",
    "SELECT count(*) AS num_rows, CAST(sum(('0x' || substr(md5(concat_ws(chr(31), "
    + ", ".join(f"coalesce({p}, chr(0))" for p in _DIGEST_PARTS)
    + ")), 1, 15))::UBIGINT) AS VARCHAR) AS digest FROM orders",
)
def q_dataset_digest(spark, sf):
    o = V.load(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        "o_orderpriority",
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
    )
    return contract.digest(o)


# ================================================================ snapshots (K8, K9)

CHURN_CUTOFF = "2000-07-01 00:00:00"
SNAPSHOT_SQL = f"""old_s AS (
  SELECT c_custkey, CASE WHEN c_custkey % 10 = 5 THEN NULL ELSE c_name END AS c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM customer),
new_s AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 10 = 2 THEN c_acctbal + 100.0 ELSE c_acctbal END AS c_acctbal,
    c_mktsegment FROM old_s
  WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{CHURN_CUTOFF}')
  UNION ALL
  SELECT s_suppkey + 10000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier)"""


def _snapshots(spark, sf):
    """Old snapshot: customers. New one: customers still ordering since the cutoff (the rest
    churned), some balances changed, and suppliers onboarded as new customers."""
    c = V.load(spark, sf, "customer")
    k = F.col("c_custkey")
    old = c.select(
        "c_custkey",
        F.when(k % 10 == 5, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("c_name"),
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
    )
    active = (
        V.load(spark, sf, "orders")
        .where(F.col("o_orderdate") >= F.expr(f"TIMESTAMP_NTZ'{CHURN_CUTOFF}'"))
        .select(F.col("o_custkey").alias("c_custkey"))
        .distinct()
    )
    kept = old.join(active, "c_custkey", "left_semi").withColumn(
        "c_acctbal", F.when(k % 10 == 2, F.col("c_acctbal") + F.lit(100.0)).otherwise(F.col("c_acctbal"))
    )
    added = V.load(spark, sf, "supplier").select(
        (F.col("s_suppkey") + F.lit(10_000_000)).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return old, kept.unionByName(added)


@query(
    "snapshot_diff",
    _with(SNAPSHOT_SQL)
    + """, j AS (
  SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, o.c_custkey IS NOT NULL AS in_old, n.c_custkey IS NOT NULL AS in_new,
    o.c_name AS o_name, o.c_nationkey AS o_nation, o.c_acctbal AS o_bal, o.c_mktsegment AS o_seg,
    n.c_name AS n_name, n.c_nationkey AS n_nation, n.c_acctbal AS n_bal, n.c_mktsegment AS n_seg
  FROM old_s o FULL OUTER JOIN new_s n ON o.c_custkey = n.c_custkey)
SELECT c_custkey, n_name AS c_name, n_nation AS c_nationkey, n_bal AS c_acctbal, n_seg AS c_mktsegment, 'insert' AS _change_type FROM j WHERE NOT in_old
UNION ALL
SELECT c_custkey, o_name, o_nation, o_bal, o_seg, 'delete' FROM j WHERE NOT in_new
UNION ALL
SELECT c_custkey, o_name, o_nation, o_bal, o_seg, 'update_preimage' FROM j
  WHERE in_old AND in_new AND (o_name IS DISTINCT FROM n_name OR o_nation IS DISTINCT FROM n_nation OR o_bal IS DISTINCT FROM n_bal OR o_seg IS DISTINCT FROM n_seg)
UNION ALL
SELECT c_custkey, n_name, n_nation, n_bal, n_seg, 'update_postimage' FROM j
  WHERE in_old AND in_new AND (o_name IS DISTINCT FROM n_name OR o_nation IS DISTINCT FROM n_nation OR o_bal IS DISTINCT FROM n_bal OR o_seg IS DISTINCT FROM n_seg)""",
)
def q_snapshot_diff(spark, sf):
    old, new = _snapshots(spark, sf)
    return snapshot.snapshot_diff(old, new, ["c_custkey"])


@query(
    "snapshot_diff_dupkeys",
    """WITH old_s AS (SELECT l_orderkey, l_returnflag, CAST(l_quantity AS BIGINT) AS qty FROM lineitem WHERE l_linenumber <> 3),
new_s AS (SELECT l_orderkey, l_returnflag, CAST(l_quantity AS BIGINT) + CASE WHEN l_orderkey % 10 = 3 THEN 1 ELSE 0 END AS qty FROM lineitem
  WHERE l_linenumber <> 2),
surplus AS (SELECT l_orderkey, l_returnflag, qty, sum(n) AS n FROM (
  SELECT *, -1 AS n FROM old_s UNION ALL SELECT *, 1 FROM new_s) GROUP BY ALL HAVING sum(n) <> 0),
each AS (SELECT l_orderkey, l_returnflag, qty, n > 0 AS is_new, unnest(range(CAST(abs(n) AS BIGINT))) AS copy FROM surplus),
numbered AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, is_new ORDER BY l_returnflag, qty) AS i,
  least(count_if(is_new) OVER (PARTITION BY l_orderkey), count_if(NOT is_new) OVER (PARTITION BY l_orderkey)) AS pairs FROM each)
SELECT l_orderkey, l_returnflag, qty,
  CASE WHEN is_new THEN CASE WHEN i <= pairs THEN 'update_postimage' ELSE 'insert' END
       ELSE CASE WHEN i <= pairs THEN 'update_preimage' ELSE 'delete' END END AS _change_type FROM numbered""",
)
def q_snapshot_diff_dupkeys(spark, sf):
    """Change feed of a table whose key repeats: lines of an order, some gone, new or changed."""
    li = V.load(spark, sf, "lineitem")
    qty = F.col("l_quantity").cast("long")
    old = li.where("l_linenumber <> 3").select("l_orderkey", "l_returnflag", qty.alias("qty"))
    bumped = qty + F.when(F.col("l_orderkey") % 10 == 3, 1).otherwise(0)
    new = li.where("l_linenumber <> 2").select("l_orderkey", "l_returnflag", bumped.alias("qty"))
    return snapshot.snapshot_diff(old, new, ["l_orderkey"])


@query(
    "snapshot_version",
    """SELECT 'orders_' || o_orderstatus AS name, max(year(o_orderdate) - 1992) AS latest_version,
  count(DISTINCT year(o_orderdate)) AS n_versions FROM orders GROUP BY 1""",
)
def q_snapshot_version(spark, sf):
    o = V.load(spark, sf, "orders")
    log = o.select(
        F.concat(F.lit("orders_"), F.col("o_orderstatus")).alias("name"),
        (F.year("o_orderdate") - F.lit(1992)).cast("long").alias("version"),
    )
    return snapshot.latest_versions(log)


# ================================================================ run log


@query(
    "metric_latest",
    _with(V.EVENT_METRICS_SQL)
    + """SELECT run_id, key, value, step, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY step DESC, ts DESC, value DESC) AS rn FROM event_metrics)
WHERE rn = 1""",
)
def q_metric_latest(spark, sf):
    return runlog.latest_metrics(V.metrics_from_events(spark, sf))


@query(
    "metric_maps",
    _with(V.EVENT_METRICS_SQL)
    + """, latest AS (SELECT run_id, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY step DESC, ts DESC, value DESC) AS rn FROM event_metrics)
  WHERE rn = 1)
SELECT run_id, count(*) AS n_metrics,
  string_agg(key || '=' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ';' ORDER BY key) AS metrics_text
FROM latest GROUP BY run_id""",
)
def q_metric_maps(spark, sf):
    maps = runlog.metric_maps(V.metrics_from_events(spark, sf))
    text = F.array_join(
        F.transform(
            F.map_entries("metrics"),
            lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(18,2)").cast("string")),
        ),
        ";",
    )
    return maps.select("run_id", F.size("metrics").cast("long").alias("n_metrics"), text.alias("metrics_text"))


CHILD_SQL = """latest AS (SELECT run_id, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY step DESC, ts DESC, value DESC) AS rn FROM event_metrics)
  WHERE rn = 1),
wide AS (
  SELECT 'parent_' || CAST(u.user_id % 10 AS VARCHAR) AS parent_run_id, CAST(u.user_id AS VARCHAR) AS run_id,
""" + ",\n".join(
    f"    max(CASE WHEN l.key = '{t}' THEN l.value END) AS {t}" for t in EVENT_TYPES
) + """
  FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN latest l ON l.run_id = CAST(u.user_id AS VARCHAR)
  GROUP BY 1, 2)"""


def _child_wide(spark, sf):
    runs, tags = V.child_runs_from_events(spark, sf)
    return runlog.child_metrics_wide(runs, tags, V.metrics_from_events(spark, sf), list(EVENT_TYPES))


@query("run_pivot", _with(V.EVENT_METRICS_SQL, CHILD_SQL) + "SELECT * FROM wide")
def q_run_pivot(spark, sf):
    return _child_wide(spark, sf)


@query(
    "best_child",
    _with(V.EVENT_METRICS_SQL, CHILD_SQL)
    + """SELECT parent_run_id, run_id AS best_run_id, purchase AS best_value FROM (
  SELECT *, row_number() OVER (PARTITION BY parent_run_id ORDER BY purchase DESC, run_id DESC) AS rn
  FROM wide WHERE purchase IS NOT NULL) WHERE rn = 1""",
)
def q_best_child(spark, sf):
    return runlog.best_child(_child_wide(spark, sf), "purchase")


SEARCH_START_MS = 788918400000  # 1995-01-01T00:00:00Z


@query(
    "run_search",
    _with(V.RUNS_SQL, V.LINE_METRICS_SQL, V.TAGS_SQL)
    + f""", latest AS (SELECT run_id, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY step DESC, ts DESC, value DESC) AS rn FROM line_metrics)
  WHERE rn = 1)
SELECT run_id, run_name, start_time FROM runs r
WHERE status = 'FINISHED' AND start_time > {SEARCH_START_MS} AND run_name LIKE '%URGENT%'
  AND run_id IN (SELECT run_id FROM latest WHERE key = 'r_price' AND value > 10000)
  AND run_id IN (SELECT run_id FROM run_tags WHERE key = 'customer' AND value <> '1')""",
)
def q_run_search(spark, sf):
    found = runlog.search_runs(
        V.runs_from_orders(spark, sf),
        V.metrics_from_lineitem(spark, sf),
        V.tags_from_orders(spark, sf),
        status="FINISHED",
        started_after_ms=SEARCH_START_MS,
        name_like="%URGENT%",
        metric_gt={"r_price": 10000},
        tag_ne={"customer": "1"},
    )
    return found.select("run_id", "run_name", "start_time")


@query(
    "run_by_name",
    _with(V.RUNS_SQL) + "SELECT run_id, experiment_id, start_time FROM runs WHERE run_name = '2-HIGH' AND lifecycle_stage = 'active'",
)
def q_run_by_name(spark, sf):
    found = runlog.search_runs(V.runs_from_orders(spark, sf), name_equals="2-HIGH", lifecycle_stage="active")
    return found.select("run_id", "experiment_id", "start_time")


LOOKUP_RUN = "7"


@query(
    "run_lookup",
    _with(V.RUNS_SQL, V.LINE_METRICS_SQL, V.TAGS_SQL)
    + f""", mine AS (SELECT * FROM runs WHERE run_id = '{LOOKUP_RUN}'),
latest AS (SELECT key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY step DESC, ts DESC, value DESC) AS rn FROM line_metrics
  WHERE run_id = '{LOOKUP_RUN}') WHERE rn = 1)
SELECT 'info' AS kind, u.key, u.value FROM (
  SELECT unnest(['run_id', 'experiment_id', 'run_name', 'status', 'start_time', 'end_time', 'artifact_uri', 'lifecycle_stage']) AS key,
    unnest([run_id, experiment_id, run_name, status, CAST(start_time AS VARCHAR), CAST(end_time AS VARCHAR), artifact_uri, lifecycle_stage]) AS value
  FROM mine) u
UNION ALL SELECT 'metric', key, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) FROM latest
UNION ALL SELECT 'param', 'clerk', 'c' || CAST(o_custkey % 97 AS VARCHAR) FROM orders WHERE o_orderkey = {LOOKUP_RUN}
UNION ALL SELECT 'tag', key, value FROM run_tags WHERE run_id = '{LOOKUP_RUN}'""",
)
def q_run_lookup(spark, sf):
    """Everything recorded about one run."""
    o = V.load(spark, sf, "orders")
    clerk = F.concat(F.lit("c"), (F.col("o_custkey") % 97).cast("string"))
    params = o.select(F.col("o_orderkey").cast("string").alias("run_id"), F.lit("clerk").alias("key"), clerk.alias("value"))
    metrics = V.metrics_from_lineitem(spark, sf).withColumn("value", F.col("value").cast("decimal(18,2)"))
    return runlog.run_lookup(LOOKUP_RUN, V.runs_from_orders(spark, sf), metrics, params, V.tags_from_orders(spark, sf))


@query(
    "experiments_by_tag",
    """WITH history AS (
  SELECT CAST(c_custkey AS VARCHAR) AS experiment_id, 'segment' AS key, 'NONE' AS value, 1 AS ts FROM customer
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'segment', c_mktsegment, 2 FROM customer WHERE c_custkey % 7 <> 0
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'nation', CAST(c_nationkey AS VARCHAR), 3 FROM customer),
latest AS (SELECT experiment_id, key, arg_max(value, ts) AS value FROM history GROUP BY 1, 2)
SELECT CAST(c_custkey AS VARCHAR) AS experiment_id, c_name AS name FROM customer
WHERE CAST(c_custkey AS VARCHAR) IN (SELECT experiment_id FROM latest WHERE key = 'segment' AND value = 'BUILDING')""",
)
def q_experiments_by_tag(spark, sf):
    c = V.load(spark, sf, "customer")
    exp = F.col("c_custkey").cast("string").alias("experiment_id")
    tag = lambda df, key, value, ts: df.select(exp, F.lit(key).alias("key"), value.alias("value"), F.lit(ts).alias("ts"))
    tags = (
        tag(c, "segment", F.lit("NONE"), 1)
        .unionByName(tag(c.where("c_custkey % 7 <> 0"), "segment", F.col("c_mktsegment"), 2))
        .unionByName(tag(c, "nation", F.col("c_nationkey").cast("string"), 3))
    )
    return runlog.experiments_by_tag(c.select(exp, F.col("c_name").alias("name")), tags, "segment", "BUILDING")


@query(
    "newest_run",
    _with(V.RUNS_SQL)
    + "SELECT run_id, run_name, start_time FROM runs WHERE status = 'FINISHED' ORDER BY start_time DESC, run_id DESC LIMIT 1",
)
def q_newest_run(spark, sf):
    runs = runlog.search_runs(V.runs_from_orders(spark, sf), status="FINISHED")
    return runlog.newest(runs, 1).select("run_id", "run_name", "start_time")


@query(
    "tag_search",
    _with(V.RUNS_SQL, V.TAGS_SQL)
    + "SELECT run_id, experiment_id FROM runs WHERE run_id IN (SELECT run_id FROM run_tags WHERE key = 'priority' AND value = '1-URGENT')",
)
def q_tag_search(spark, sf):
    runs = runlog.search_runs(V.runs_from_orders(spark, sf), tags=V.tags_from_orders(spark, sf), tag_eq={"priority": "1-URGENT"})
    return runs.select("run_id", "experiment_id")


@query(
    "param_merge",
    """WITH existing AS (
  SELECT CAST(p_partkey AS VARCHAR) AS run_id, 'brand' AS key, p_brand AS value FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'size', CAST(p_size AS VARCHAR) FROM part),
new AS (
  SELECT CAST(p_partkey AS VARCHAR) AS run_id, 'size' AS key,
    CAST(p_size + CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS value FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'type', p_type FROM part)
SELECT n.run_id, n.key, n.value, e.value AS logged_value,
  CASE WHEN e.run_id IS NULL THEN 'new' WHEN e.value IS NOT DISTINCT FROM n.value THEN 'same' ELSE 'conflict' END AS outcome
FROM new n LEFT JOIN existing e ON n.run_id = e.run_id AND n.key = e.key""",
)
def q_param_merge(spark, sf):
    p = V.load(spark, sf, "part")
    rid = F.col("p_partkey").cast("string").alias("run_id")
    existing = p.select(rid, F.lit("brand").alias("key"), F.col("p_brand").alias("value")).unionByName(
        p.select(rid, F.lit("size").alias("key"), F.col("p_size").cast("string").alias("value"))
    )
    bumped = (F.col("p_size") + F.when(F.col("p_partkey") % 5 == 0, 1).otherwise(0)).cast("string")
    new = p.select(rid, F.lit("size").alias("key"), bumped.alias("value")).unionByName(
        p.select(rid, F.lit("type").alias("key"), F.col("p_type").alias("value"))
    )
    return runlog.merge_params(existing, new)


@query(
    "param_merge_batch",
    """WITH logged AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'flag' AS key, 'N' AS value FROM orders WHERE o_orderkey % 3 = 0),
new AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS run_id, 'flag' AS key, l_returnflag AS value FROM lineitem),
given AS (SELECT run_id, key, count(*) AS n FROM new GROUP BY ALL)
SELECT n.run_id, n.key, n.value, l.value AS logged_value,
  CASE WHEN g.n > 1 THEN 'conflict' WHEN l.run_id IS NULL THEN 'new' WHEN l.value = n.value THEN 'same' ELSE 'conflict' END AS outcome
FROM new n JOIN given g USING (run_id, key) LEFT JOIN logged l ON l.run_id = n.run_id AND l.key = n.key""",
)
def q_param_merge_batch(spark, sf):
    """A batch that gives some params several times, with one value or with several."""
    rows = lambda df, key, value: df.select(F.col(key).cast("string").alias("run_id"), F.lit("flag").alias("key"), value.alias("value"))
    logged = rows(V.load(spark, sf, "orders").where("o_orderkey % 3 = 0"), "o_orderkey", F.lit("N"))
    return runlog.merge_params(logged, rows(V.load(spark, sf, "lineitem"), "l_orderkey", F.col("l_returnflag")))


@query(
    "param_maps",
    """SELECT CAST(p_partkey AS VARCHAR) AS run_id, 3 AS n_params,
  'brand=' || p_brand || ';size=' || CAST(p_size AS VARCHAR) || ';type=' || p_type AS params_text FROM part""",
)
def q_param_maps(spark, sf):
    p = V.load(spark, sf, "part")
    one = lambda key, value: p.select(F.col("p_partkey").cast("string").alias("run_id"), F.lit(key).alias("key"), value.alias("value"))
    rows = one("type", F.col("p_type")).unionByName(one("size", F.col("p_size").cast("string"))).unionByName(one("brand", F.col("p_brand")))
    maps = runlog.kv_maps(rows, "params")
    text = F.array_join(F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return maps.select("run_id", F.size("params").alias("n_params"), text.alias("params_text"))


@query(
    "run_inputs",
    """SELECT CAST(l_orderkey AS VARCHAR) AS run_id, CASE WHEN l_returnflag = 'R' THEN 'eval' ELSE 'training' END AS context,
  CAST(p_partkey AS VARCHAR) AS digest, p_name AS name FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def q_run_inputs(spark, sf):
    context = F.when(F.col("l_returnflag") == "R", F.lit("eval")).otherwise(F.lit("training"))
    inputs = V.load(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("run_id"), F.col("l_partkey").cast("string").alias("dataset_digest"), context.alias("context")
    )
    datasets = V.load(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("digest"), F.col("p_name").alias("name"))
    return runlog.run_inputs(inputs, datasets)


@query(
    "alias_reserved",
    """SELECT alias, lower(alias) <> 'latest' AS allowed, count(*) AS n FROM (
  SELECT CASE o_orderkey % 10 WHEN 0 THEN 'Latest' WHEN 1 THEN 'latest' WHEN 2 THEN 'latest-model' ELSE lower(o_orderpriority) END AS alias
  FROM orders) GROUP BY ALL""",
)
def q_alias_reserved(spark, sf):
    m = F.col("o_orderkey") % 10
    alias = F.when(m == 0, "Latest").when(m == 1, "latest").when(m == 2, "latest-model").otherwise(F.lower("o_orderpriority"))
    rows = V.load(spark, sf, "orders").select(alias.alias("alias"))
    return rows.groupBy("alias", runlog.alias_allowed("alias").alias("allowed")).agg(F.count("*").alias("n"))


def _versions(spark, sf):
    regs = V.registrations_from_orders(spark, sf)
    return runlog.assign_versions(regs, None, ["created", "o_orderkey"])


@query("version_numbers", _with(V.REGISTRATIONS_SQL) + "SELECT name, version, run_id, created FROM versions")
def q_version_numbers(spark, sf):
    return _versions(spark, sf).select("name", "version", "run_id", "created")


REGISTER_SINCE_MS = 788918400000  # 1995-01-01T00:00:00Z


@query(
    "register_rows",
    _with(V.REGISTRATIONS_SQL)
    + f""", before AS (SELECT name, max(version) AS top FROM versions WHERE created < {REGISTER_SINCE_MS} GROUP BY name)
SELECT name, coalesce(top, 0) + row_number() OVER (PARTITION BY name ORDER BY created, o_orderkey) AS version, run_id
FROM versions LEFT JOIN before USING (name) WHERE created >= {REGISTER_SINCE_MS}""",
)
def q_register_rows(spark, sf):
    """New registrations, numbered on from the versions that a model has."""
    there = _versions(spark, sf).where(F.col("created") < REGISTER_SINCE_MS).select("name", "version")
    new = V.registrations_from_orders(spark, sf).where(F.col("created") >= REGISTER_SINCE_MS)
    return runlog.assign_versions(new, there, ["created", "o_orderkey"]).select("name", "version", "run_id")


@query(
    "versions_of",
    _with(V.REGISTRATIONS_SQL)
    + """SELECT v.name, v.version, v.run_id FROM versions v JOIN orders o ON v.o_orderkey = o.o_orderkey
WHERE v.name = 'model_7' OR o.o_orderpriority = '1-URGENT'""",
)
def q_versions_of(spark, sf):
    """Versions of one model, and versions with a tag."""
    regs = V.registrations_from_orders(spark, sf)
    orders = V.load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    tagged = runlog.assign_versions(regs, None, ["created", "o_orderkey"]).join(orders, "o_orderkey")
    tagged = tagged.withColumn("tags", F.create_map(F.lit("priority"), "o_orderpriority"))
    both = runlog.versions_of(tagged, "model_7").unionByName(runlog.versions_of(tagged, tags={"priority": "1-URGENT"}))
    return both.select("name", "version", "run_id").distinct()


@query(
    "upsert_latest",
    _with(V.REGISTRATIONS_SQL)
    + """SELECT name, 'champion' AS alias, version, created AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY created DESC, version DESC) AS rn FROM versions) WHERE rn = 1""",
)
def q_upsert_latest(spark, sf):
    v = _versions(spark, sf)
    aliases = v.select("name", F.lit("champion").alias("alias"), "version", F.col("created").alias("ts"))
    return runlog.upsert_latest(aliases, ["name", "alias"], "ts", tiebreak=["version"])


@query(
    "alias_resolve",
    _with(V.REGISTRATIONS_SQL)
    + """, """ + V.RUNS_SQL + """SELECT v.name, v.version, v.run_id, v.source, r.run_name, r.artifact_uri FROM versions v JOIN (
  SELECT name, max(version) AS version FROM versions GROUP BY name) a ON v.name = a.name AND v.version = a.version
LEFT JOIN runs r ON r.run_id = v.run_id""",
)
def q_alias_resolve(spark, sf):
    """Alias -> version -> run -> artifact folder, for every alias."""
    v = _versions(spark, sf).drop("o_orderkey")
    aliases = v.select("name", F.lit("champion").alias("alias"), "version", F.col("created").alias("ts"))
    got = runlog.resolve_aliases(aliases, v, V.runs_from_orders(spark, sf), tiebreak=["version"])
    return got.select("name", "version", "run_id", "source", "run_name", "artifact_uri")


# ================================================================ head / limit


@query("head_n", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 10")
def q_head_n(spark, sf):
    return V.load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy("c_custkey").limit(10)


# ================================================================ model fit and scoring

DOC_SPEC = FeatureSpec(
    num_features=("n_chars",),
    cat_features=("lang", "source"),
    target="quality_label",
    id_columns=("doc_id",),
)
# The full settings of the original model; the boosting ends before its last round if the loss on
# a tenth of the training rows stops falling.
QUERY_BOOST = dict(validation_share=0.1)
FIT_PARTITIONS = 8
DOC_LABELS = {"High": "keep", "Low": "drop"}


def _labeled_docs(spark, sf):
    labels = V.load(spark, sf, "labels")
    docs = V.load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    label = F.when(F.col("quality") == 1, F.lit("High")).otherwise(F.lit("Low"))
    return docs, labels.join(docs, "doc_id").select("doc_id", "lang", "source", "n_chars", label.alias("quality_label"))


def _doc_split(spark, sf):
    docs, labeled = _labeled_docs(spark, sf)
    return docs, *split.train_test(split.exact_split(labeled, "doc_id", TEST_RATIO, SEED))


def _fit_docs(spark, sf, boost: dict | None = None):
    from tabula.operators import train

    docs, tr, te = _doc_split(spark, sf)
    model = train.fit(tr, DOC_SPEC, train.BoostParams(**(QUERY_BOOST if boost is None else boost)), partitions=FIT_PARTITIONS)
    return train, model, docs, tr, te


LABELED_SQL = f"""labeled AS (
  SELECT l.doc_id, d.lang, d.source, d.n_chars, CASE WHEN l.quality = 1 THEN 'High' ELSE 'Low' END AS quality_label
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
doc_ranked AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn, count(*) OVER () AS n FROM labeled),
doc_train AS (SELECT * FROM doc_ranked WHERE rn > ceil({TEST_RATIO} * n))"""


@query(
    "label_index",
    _with(LABELED_SQL)
    + """SELECT doc_id, quality_label, CAST(dense_rank() OVER (ORDER BY quality_label) - 1 AS DOUBLE) AS label_index FROM doc_train""",
)
def q_label_index(spark, sf):
    """Label encoding of the training rows: classes numbered in alphabetical order."""
    from tabula.operators import train

    _, tr, _ = _doc_split(spark, sf)
    model = train.build_features(DOC_SPEC).fit(tr)
    return model.transform(tr).select("doc_id", "quality_label", F.col(train.LABEL).alias("label_index"))


@query(
    "assembled_vector",
    _with(LABELED_SQL)
    + """, langs AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS i FROM (SELECT DISTINCT lang FROM doc_train)),
sources AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS i FROM (SELECT DISTINCT source FROM doc_train)),
sizes AS (SELECT (SELECT count(*) FROM langs) AS n_lang, (SELECT count(*) FROM sources) AS n_source)
SELECT doc_id, CAST(i AS INTEGER) AS slot, 1.0::DOUBLE AS value FROM documents JOIN langs USING (lang)
UNION ALL SELECT doc_id, CAST(n_lang + i AS INTEGER), 1.0::DOUBLE FROM documents JOIN sources USING (source), sizes
UNION ALL SELECT doc_id, CAST(n_lang + n_source AS INTEGER), CAST(n_chars AS DOUBLE) FROM documents, sizes WHERE n_chars <> 0""",
)
def q_assembled_vector(spark, sf):
    """The feature vector of every document under the stages fitted on the training rows, as
    its non-zero slots: the one-hot blocks, then the numbers, then their missing flags."""
    from pyspark.ml.functions import vector_to_array

    from tabula.operators import train

    docs, tr, _ = _doc_split(spark, sf)
    model = train.build_features(DOC_SPEC).fit(tr)
    rows = model.transform(docs.withColumn(DOC_SPEC.target, F.lit("High")))
    slots = rows.select("doc_id", F.posexplode(vector_to_array(train.FEATURES)).alias("slot", "value"))
    return slots.where("value <> 0")


@query("gbt_score", None)
def q_gbt_score(spark, sf):
    """Fit on the labeled training split, batch-score every document (one row each)."""
    train, model, docs, tr, _ = _fit_docs(spark, sf)
    contract_ = train.input_contract(tr, DOC_SPEC)
    return train.score(model, docs, DOC_SPEC, contract=contract_, keep=["doc_id"], labels=DOC_LABELS)


@query(
    "gbt_score_count",
    """SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, CAST(count_if(doc_id IS NULL) AS BIGINT) AS n_bad_labels,
  CAST(count(*) - count(doc_id) AS BIGINT) AS n_changed_by_reload FROM documents""",
)
def q_gbt_score_count(spark, sf):
    """What must hold of the scores whatever the model: one row per document, only known labels,
    and the same scores from the saved and reloaded model."""
    from tabula.session import ensure_checkpoint_dir

    train, model, docs, _, _ = _fit_docs(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/gbt-{uuid.uuid4().hex}"
    train.save(model, path)
    score = lambda m, out: train.score(m, docs, DOC_SPEC, keep=["doc_id"], labels=DOC_LABELS, out=out)
    both = score(model, "a").join(score(train.load(path), "b"), "doc_id", "full")
    return both.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("doc_id").alias("n_ids"),
        F.count_if(~F.coalesce(F.col("a").isin(list(DOC_LABELS.values())), F.lit(False))).alias("n_bad_labels"),
        F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_changed_by_reload"),
    )


@query("gbt_metrics", None)
def q_gbt_metrics(spark, sf):
    """Fit, score the test split, and report the long metric rows."""
    train, model, _, tr, te = _fit_docs(spark, sf)
    scored = train.score(model, te, DOC_SPEC, keep=["doc_id", "quality_label"], out="predicted")
    m = evaluate.metrics_long(scored, "quality_label", "predicted", "High")
    return m.select("key", r6("value").alias("value"))


@query(
    "batch_function",
    "SELECT doc_id, lang, CASE WHEN n_chars >= 1000 THEN 'Room Reserved' ELSE 'Room Not Reserved' END AS prediction FROM documents",
)
def q_batch_function(spark, sf):
    from tabula.operators.batch import ModelWrapper, ThresholdModel, score_batches

    wrapper = ModelWrapper(ThresholdModel("n_chars", 1000, "Not_Canceled", "Canceled"), decode.PREDICTION_LABELS)
    docs = V.load(spark, sf, "documents")
    return score_batches(docs, wrapper, inputs=["n_chars"], keep=["doc_id", "lang"])
