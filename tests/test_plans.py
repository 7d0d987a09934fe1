"""Plan properties that matter at scale, checked on the formatted physical plan."""

import contextlib
import io
import re

from tabula.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def shuffles(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", text, re.M))


def test_exact_split_is_map_only_and_reads_the_id(spark):
    text = plan(catalog.QUERIES["exact_split"](spark, SF))
    assert shuffles(text) == 0 and "SortMergeJoin" not in text and "Window" not in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_evaluation_reads_confusion_once_and_never_the_text(spark):
    for name in ("class_report", "metrics_long"):
        text = plan(catalog.QUERIES[name](spark, SF))
        assert shuffles(text) <= 3, name
        assert "text:string" not in text
    text = plan(catalog.QUERIES["batch_function"](spark, SF))
    assert "text:string" not in text


def test_filters_reach_the_scan(spark):
    text = plan(catalog.QUERIES["snapshot_diff"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in text
    text = plan(catalog.QUERIES["tag_search"](spark, SF))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text


def test_hot_key_aggregations_combine_map_side(spark):
    for name in ("metric_latest", "upsert_latest", "snapshot_diff"):
        text = plan(catalog.QUERIES[name](spark, SF))
        assert "partial_" in text, name  # partial aggregation before the shuffle


def test_run_search_cuts_histories_before_reducing_them(spark):
    text = plan(catalog.QUERIES["run_search"](spark, SF))
    tree = text[: text.index("\n\n(1)")]
    lines = [x for x in tree.splitlines() if "lineitem" in x or "LeftSemi" in x or "Aggregate" in x or "Join" in x]
    joins = [i for i, x in enumerate(lines) if "Join" in x]
    aggregates = [i for i, x in enumerate(lines) if "Aggregate" in x]
    assert max(joins) > max(aggregates)  # a join lies below the aggregates
    assert "In(l_returnflag" in text or "r_price" in text


def test_numbering_small_groups_needs_no_join(spark):
    text = plan(catalog.QUERIES["version_numbers"](spark, SF))
    assert "Join" not in text and shuffles(text) == 1
