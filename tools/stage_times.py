"""Summarise stage times from a Spark event log folder (written by bench.py).

    python tools/stage_times.py /tmp/tabula-bench-XXXX/events [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of one event-log part (plain or zstd-compressed)."""
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        with open(path) as f:
            yield from f


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    stages = {}
    tasks = defaultdict(int)
    for path in sorted(glob.glob(os.path.join(folder, "**", "*"), recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                took = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
                stages[info["Stage ID"]] = (took, info.get("Number of Tasks", 0), info.get("Stage Name", "")[:90])
            elif kind == "SparkListenerTaskEnd":
                tasks[ev["Stage ID"]] += 1
    total = sum(t for t, _, _ in stages.values())
    print(f"{len(stages)} stages, {total / 1000:.1f} s of stage time")
    for sid, (took, n, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:5d} {took / 1000:7.2f} s  tasks={n:4d}  {name}")


if __name__ == "__main__":
    main()
