"""Summarise a Spark event log: per stage, wall time, task count, median and max task time.

A max far above the median marks a skewed stage. Usage:
    python tools/stage_times.py <event-log-file-or-dir> [top_n]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
from collections import defaultdict


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = [path]
    if os.path.isdir(path):  # rolling logs: folders of event files
        files = sorted(os.path.join(root, f) for root, _, names in os.walk(path) for f in names
                       if not f.startswith(".") and not f.startswith("appstatus"))
    tasks: dict[tuple[int, int], list[float]] = defaultdict(list)
    stages = {}
    for f in files:
        for line in _lines(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                info = ev["Task Info"]
                key = (ev["Stage ID"], ev["Stage Attempt ID"])
                tasks[key].append((info["Finish Time"] - info["Launch Time"]) / 1000.0)
            elif kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                key = (si["Stage ID"], si["Stage Attempt ID"])
                wall = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000.0
                stages[key] = (si["Stage Name"][:60], wall)
    rows = []
    for key, (name, wall) in stages.items():
        t = tasks.get(key, [0.0])
        rows.append((wall, key[0], name, len(t), statistics.median(t), max(t)))
    rows.sort(reverse=True)
    print(f"{'stage':>6} {'wall_s':>7} {'tasks':>6} {'med_s':>6} {'max_s':>6}  name")
    for wall, sid, name, n, med, mx in rows[:top]:
        print(f"{sid:>6} {wall:7.2f} {n:6d} {med:6.2f} {mx:6.2f}  {name}")


if __name__ == "__main__":
    main()
