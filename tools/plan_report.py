"""Summarise the physical plan of every registered query into PLANS.md.

    python tools/plan_report.py [sf_dir] > PLANS.md

Plans are the ones Catalyst produces before adaptive execution; at run time AQE may
turn a sort-merge join into a broadcast join when a side is measured small, and
coalesces shuffle partitions.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabula.plans.catalog import QUERIES  # noqa: E402
from tabula.session import build_session  # noqa: E402

SKIP_PLAN = {"gbt_score", "gbt_metrics"}  # Spark ML fits run jobs while the plan is built


def summarise(text: str) -> dict:
    nodes = re.findall(r"^\((\d+)\) (\w[\w ]*?)(?: \[codegen id : \d+\])?$", text, re.M)
    names = [n for _, n in nodes]
    scans = re.findall(
        r"Location: \w+ \[[^\]\n]*?([^/\]\n]+\.parquet)\]\n(?:PushedFilters: (\[[^\n]*\])\n)?ReadSchema: (struct<[^\n]*>)", text
    )
    joins = [n for n in names if "Join" in n]
    aggs = sorted({n for n in names if "Aggregate" in n})
    return {
        "exchanges": sum(n in ("Exchange",) for n in names),
        "broadcasts": sum(n == "BroadcastExchange" for n in names),
        "joins": joins,
        "aggregates": aggs,
        "python": [n for n in names if "Python" in n or "MapInPandas" in n or "ArrowEval" in n],
        "scans": scans,
        "codegen": len(re.findall(r"WholeStageCodegen", text)),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    print("# Physical plans of the registered queries\n")
    print("Generated by `tools/plan_report.py` from `explain(\"formatted\")` (plans before adaptive")
    print("execution; AQE can still switch a sort-merge join to broadcast when a side is measured small).")
    print("Driver-side passes that run while a query is built (exact split / median counting passes,")
    print("category collection, model fit) are not part of these plans.\n")
    print("| query | shuffles | broadcasts | joins | aggregates | python | scans: file, pushed filters, columns read |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name in SKIP_PLAN:
            continue
        df = fn(spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        s = summarise(buf.getvalue())
        scans = "<br>".join(
            f"`{f}` {p or '[]'} `{', '.join(re.findall(r'(\w+):', cols[7:-1]))}`" for f, p, cols in s["scans"]
        )
        print(f"| {name} | {s['exchanges']} | {s['broadcasts']} | {', '.join(s['joins']) or '-'} | "
              f"{', '.join(s['aggregates']) or '-'} | {', '.join(s['python']) or '-'} | {scans} |")


if __name__ == "__main__":
    main()
