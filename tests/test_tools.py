"""The helper tools parse what Spark writes."""

import json
import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def test_plan_summary_parses_formatted_plan():
    from plan_report import summarise

    text = """(1) Scan parquet 
Output [1]: [o_orderkey#0L]
Location: InMemoryFileIndex [file:/data/orders.parquet]
PushedFilters: [IsNotNull(o_orderkey)]
ReadSchema: struct<o_orderkey:bigint>

(2) Exchange
(3) HashAggregate [codegen id : 1]
(4) BroadcastHashJoin [codegen id : 2]
"""
    s = summarise(text)
    assert s["exchanges"] == 1 and s["joins"] == ["BroadcastHashJoin"] and s["aggregates"] == ["HashAggregate"]
    assert s["scans"] == [("orders.parquet", "[IsNotNull(o_orderkey)]", "struct<o_orderkey:bigint>")]


def test_stage_times_reads_plain_and_zstd(tmp_dir):
    import zstandard

    from stage_times import _lines

    ev = json.dumps({"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": 1}}) + "\n"
    plain = os.path.join(tmp_dir, "events_1")
    with open(plain, "w") as f:
        f.write(ev)
    packed = os.path.join(tmp_dir, "events_2.zstd")
    with open(packed, "wb") as f:
        f.write(zstandard.ZstdCompressor().compress(ev.encode()))
    assert list(_lines(plain)) == [ev] and list(_lines(packed)) == [ev]
