"""Summarise stage and task times from a Spark event log (no UI needed).

usage: python tools/eventlog_stages.py <event log file> [top_n]
Run a job with spark.eventLog.enabled=true and spark.eventLog.dir=<scratch>.
"""

import json
import os
import sys
from collections import defaultdict


def lines(path):
    """A plain log file, or a rolling log folder (events_<n>_... files)."""
    files = [path] if os.path.isfile(path) else sorted(
        (os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_")),
        key=lambda f: int(os.path.basename(f).split("_")[1]))
    for f in files:
        if f.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
            import io
            import zstandard
            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f) as fh:
                yield from fh


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = {}
    task_ms = defaultdict(float)
    shuffle_w = defaultdict(int)
    for line in lines(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            key = (info["Stage ID"], info.get("Stage Attempt ID", 0))
            dur = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
            stages[key] = (dur, info["Stage Name"], info["Number of Tasks"])
        elif ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            key = (e["Stage ID"], e.get("Stage Attempt ID", 0))
            task_ms[key] += m.get("Executor Run Time", 0)
            shuffle_w[key] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    total = sum(d for d, _, _ in stages.values())
    print(f"stages: {len(stages)}, wall ms summed over stages: {total}")
    print("stage | wall ms | task ms | tasks | shuffle written | name")
    for key, (dur, name, n) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"{key[0]} | {dur} | {task_ms[key]:.0f} | {n} | {shuffle_w[key]} | {name[:70]}")


if __name__ == "__main__":
    main()
