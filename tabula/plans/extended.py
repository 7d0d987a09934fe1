"""More queries of the catalog: run search by conditions, boosting and its scorer, medians per group, and
what goes through files and tables in the shared folder. Each registers like those of ``catalog``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabula import sources
from tabula.operators import boosting, runsearch, tables
from tabula.operators.group_select import group_medians
from tabula.operators.runsearch import Condition, Order
from tabula.plans import views as V
from tabula.plans.catalog import DOC_LABELS, LABELED_SQL, _doc_split, _with, query, r6
from tabula.session import ensure_checkpoint_dir

_LATEST_SQL = """latest AS (SELECT run_id, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY step DESC, ts DESC, value DESC) AS rn FROM line_metrics)
  WHERE rn = 1)"""


# ================================================================ run search


@query(
    "run_search_conditions",
    _with(V.RUNS_SQL, V.LINE_METRICS_SQL, V.TAGS_SQL, _LATEST_SQL)
    + """SELECT run_id, run_name, status, start_time FROM runs
WHERE status <> 'RUNNING' AND start_time >= 700000000000 AND run_name ILIKE '%h%'
  AND run_id IN (SELECT run_id FROM latest WHERE key = 'n_price' AND value > 10000)
  AND run_id IN (SELECT run_id FROM latest WHERE key = 'r_price' AND value <= 60000)
  AND run_id IN (SELECT run_id FROM run_tags WHERE key = 'customer' AND value NOT IN ('1', '2', '3'))
  AND run_id IN (SELECT run_id FROM run_tags WHERE key = 'priority' AND value LIKE '%-%')""",
)
def q_run_search_conditions(spark, sf):
    found = runsearch.search(
        V.runs_from_orders(spark, sf),
        [
            Condition("attribute", "status", "!=", "RUNNING"),
            Condition("attribute", "start_time", ">=", 700_000_000_000),
            Condition("attribute", "run_name", "ilike", "%h%"),
            Condition("metric", "n_price", ">", 10_000),
            Condition("metric", "r_price", "<=", 60_000),
            Condition("tag", "customer", "not in", ["1", "2", "3"]),
            Condition("tag", "priority", "like", "%-%"),
        ],
        metrics=V.metrics_from_lineitem(spark, sf),
        tags=V.tags_from_orders(spark, sf),
    )
    return found.select("run_id", "run_name", "status", "start_time")


@query(
    "run_search_ordered",
    _with(V.RUNS_SQL, V.LINE_METRICS_SQL, V.TAGS_SQL, _LATEST_SQL)
    + """SELECT r.run_id, r.start_time, round(a.value, 6) + 0.0 AS price FROM runs r
JOIN latest a ON a.run_id = r.run_id AND a.key = 'a_price'
WHERE r.status = 'FINISHED'
ORDER BY a.value DESC, r.start_time, r.run_id LIMIT 100""",
)
def q_run_search_ordered(spark, sf):
    """The hundred finished runs with the largest latest metric (a top-k report)."""
    metrics = V.metrics_from_lineitem(spark, sf)
    found = runsearch.search(
        V.runs_from_orders(spark, sf),
        [Condition("attribute", "status", "=", "FINISHED"), Condition("metric", "a_price", ">", 0)],
        metrics=metrics,
        order_by=[Order("metric", "a_price", False), Order("attribute", "start_time")],
        limit=100,
    )
    price = runsearch.latest_metrics(runsearch.by_run(metrics.where(F.col("key") == "a_price"))).select("run_id", r6("value").alias("price"))
    return found.join(price, "run_id").select("run_id", "start_time", "price")


# ================================================================ medians per group (A2, M3)


@query(
    "median_per_flag",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(median(l_extendedprice), 6) + 0.0 AS median
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def q_median_per_flag(spark, sf):
    """Few groups, some with a third of the rows or more."""
    made = group_medians(V.load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return made.withColumn("median", r6("median"))


@query(
    "median_per_customer",
    _with(V.GAPS_SQL)
    + """SELECT o_custkey, count(g.price) FILTER (NOT isnan(g.price)) AS n,
  round(median(g.price) FILTER (NOT isnan(g.price)), 6) + 0.0 AS median
FROM orders o JOIN gaps g USING (o_orderkey) GROUP BY o_custkey""",
)
def q_median_per_customer(spark, sf):
    """Many small groups of a column with gaps."""
    prices = V.orders_with_gaps(spark, sf).select("o_orderkey", "price")
    rows = V.load(spark, sf, "orders").select("o_orderkey", "o_custkey").join(prices, "o_orderkey")
    return group_medians(rows, ["o_custkey"], "price").withColumn("median", r6("median"))


# ================================================================ leaf-wise boosting

LENGTHS = [200.0, 500.0, 1000.0, 2000.0, 5000.0]
_LENGTHS_SQL = ", ".join(f"({b})" for b in LENGTHS)


@query(
    "leafwise_root_splits",
    _with(LABELED_SQL)
    + f""", rows AS (SELECT n_chars, lang, source, CASE WHEN quality_label = 'Low' THEN 1.0 ELSE 0.0 END AS y FROM doc_train),
start AS (SELECT avg(y) AS p FROM rows),
gh AS (SELECT r.*, p - y AS g, p * (1 - p) AS h FROM rows r, start),
whole AS (SELECT count(*) AS n, sum(g) AS g, sum(h) AS h FROM gh),
lefts AS (
  SELECT 'n_chars' AS feature, b::DOUBLE AS bound, NULL AS category, count(*) AS n, sum(g) AS g, sum(h) AS h
  FROM gh, (VALUES {_LENGTHS_SQL}) v(b) WHERE n_chars <= b GROUP BY b
  UNION ALL SELECT 'lang', NULL, lang, count(*), sum(g), sum(h) FROM gh GROUP BY lang
  UNION ALL SELECT 'source', NULL, source, count(*), sum(g), sum(h) FROM gh GROUP BY source)
SELECT feature, bound, category, l.n AS n_left, w.n - l.n AS n_right,
  round(l.g * l.g / l.h + (w.g - l.g) * (w.g - l.g) / (w.h - l.h) - w.g * w.g / w.h, 4) + 0.0 AS gain
FROM lefts l, whole w WHERE l.n >= 20 AND w.n - l.n >= 20""",
)
def q_leafwise_root_splits(spark, sf):
    """Every split that the first tree may begin with, and its gain, from histograms of the training rows."""
    _, tr, _ = _doc_split(spark, sf)
    features = [boosting.Feature("n_chars", bounds=LENGTHS), *boosting.fit_features(tr, [], ["lang", "source"])]
    made = boosting.root_splits(tr, "quality_label", features)
    return made.where("bound is not null or category is not null").withColumn("gain", F.round("gain", 4) + F.lit(0.0))


def _leafwise(spark, sf):
    docs, tr, te = _doc_split(spark, sf)
    params = boosting.LeafwiseParams(rounds=8, validation_share=0.1)
    return docs, te, boosting.fit(tr, "quality_label", ["n_chars"], ["lang", "source"], params)


@query(
    "leafwise_score_agreement",
    """SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, CAST(0 AS BIGINT) AS n_unlike_batches, CAST(0 AS BIGINT) AS n_unlike_reloaded,
  CAST(0 AS BIGINT) AS n_without FROM documents""",
)
def q_leafwise_score_agreement(spark, sf):
    """All documents scored by the compiled expression, by batches, and by the reloaded model."""
    docs, _, model = _leafwise(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/leafwise-{uuid.uuid4().hex}"
    model.save(spark, path)
    scored = boosting.load(spark, path).score_batches(model.score_batches(model.score(docs, "_a"), "_b"), "_c")
    unlike = lambda c: F.count_if(~F.coalesce(F.abs(F.col("_a") - F.col(c)) <= 1e-12, F.lit(False)))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("doc_id").alias("n_ids"), unlike("_b").alias("n_unlike_batches"),
        unlike("_c").alias("n_unlike_reloaded"), F.count_if(F.col("_a").isNull()).alias("n_without"),
    )


@query("leafwise_score", None)
def q_leafwise_score(spark, sf):
    """Fit on the labeled training split, score and label every document (one row each)."""
    docs, _, model = _leafwise(spark, sf)
    label = F.create_map(*[F.lit(x) for pair in DOC_LABELS.items() for x in pair])
    return model.predict(model.score(docs, "score")).select("doc_id", r6("score").alias("score"), label[F.col("predicted_class")].alias("label"))


# ================================================================ files and tables in the shared folder

_LINE = "concat_ws(',', o_orderkey, o_totalprice, o_orderpriority{})"


@query(
    "csv_rejects",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CASE WHEN o_orderkey % 10 = 0 OR o_orderkey % 15 = 1 THEN 'rejected' ELSE 'good' END AS outcome,
  CASE WHEN o_orderkey % 10 <> 0 AND o_orderkey % 15 <> 1 AND o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority
FROM orders""",
)
def q_csv_rejects(spark, sf):
    """orders written as text with too short and too long lines and missing tokens, read back with the rejects."""
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    o = V.load(spark, sf, "orders").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_orderpriority")))
    short, long_ = F.expr("concat_ws(',', o_orderkey, o_totalprice)"), F.expr(_LINE.format(", 'more'"))
    line = F.when(F.col("o_orderkey") % 10 == 0, short).when(F.col("o_orderkey") % 15 == 1, long_).otherwise(F.expr(_LINE.format("")))
    lines = o.select(line.alias("o_orderkey,o_totalprice,o_orderpriority"))
    lines.write.option("header", True).option("quote", "").option("sep", "\x01").csv(path)
    good, rejects = sources.read_csv_checked(spark, path, ["o_orderkey", "o_orderpriority"])
    bad = rejects.select(F.split("row", ",")[0].alias("o_orderkey"), F.lit("rejected").alias("outcome"), F.lit(None).cast("string").alias("o_orderpriority"))
    return good.select("o_orderkey", F.lit("good").alias("outcome"), "o_orderpriority").unionByName(bad)


_MIXED = """CASE event_id % 5 WHEN 0 THEN props
  WHEN 1 THEN '{"u": {"id": ' || CAST(user_id AS STRING) || ', "type": "' || event_type || '"}, "v": null}'
  WHEN 2 THEN 'no document' WHEN 4 THEN '[1, 2.5]' END"""


@query(
    "document_shape",
    """WITH c AS (SELECT event_id % 5 AS m, count(*) AS n FROM events GROUP BY 1),
shapes AS (SELECT * FROM (VALUES (0, '$', 'OBJECT'), (0, '$.k', 'BIGINT'), (1, '$', 'OBJECT'), (1, '$.u', 'OBJECT'), (1, '$.v', 'VOID'),
  (1, '$.u.id', 'BIGINT'), (1, '$.u.type', 'STRING'), (2, 'invalid', 'invalid'), (4, '$', 'ARRAY')) s(m, path, kind))
SELECT path, kind, CAST(sum(n) AS BIGINT) AS n FROM shapes JOIN c USING (m) GROUP BY path, kind""",
)
def q_document_shape(spark, sf):
    """Paths and kinds of documents of several shapes in one column."""
    found = sources.document_shape(V.load(spark, sf, "events").select(F.expr(_MIXED).alias("document")), "document")
    return found.groupBy("path", "kind").agg(F.sum("n").alias("n"))


@query(
    "document_values",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  CASE WHEN event_id % 5 = 1 THEN user_id END AS id, CASE WHEN event_id % 5 = 1 THEN event_type END AS type,
  CASE WHEN event_id % 5 = 4 THEN 2.5::DOUBLE END AS second FROM events""",
)
def q_document_values(spark, sf):
    docs = V.load(spark, sf, "events").select("event_id", F.expr(_MIXED).alias("document"))
    paths = {"k": ("$.k", "bigint"), "id": ("$.u.id", "bigint"), "type": ("$.u.type", "string"), "second": ("$[1]", "double")}
    return sources.document_values(docs, "document", paths, ["event_id"])


@query(
    "append_dedup",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 'first' ELSE 'second' END AS written, round(o_totalprice, 6) + 0.0 AS price
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""",
)
def q_append_dedup(spark, sf):
    """A table of some orders, to which overlapping ones are appended twice by key; each key stays as first written."""
    name, path = f"append_{uuid.uuid4().hex}", f"{ensure_checkpoint_dir(spark)}/append-{uuid.uuid4().hex}"
    o = V.load(spark, sf, "orders").select("o_orderkey", r6("o_totalprice").alias("price"))
    try:
        tables.overwrite_table(o.where("o_orderkey % 3 <> 0").withColumn("written", F.lit("first")), name)
        more = o.where("o_orderkey % 2 = 0").withColumn("written", F.lit("second")).select("o_orderkey", "price", "written")
        for _ in range(2):
            tables.append_table(more, name, keys=["o_orderkey"])
        spark.table(name).write.parquet(path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(path).select("o_orderkey", "written", "price")
