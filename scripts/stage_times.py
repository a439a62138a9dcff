"""Summarize a Spark event log: per job group (query), jobs, stages, tasks, task time,
shuffle bytes and spill.  Usage: ``python scripts/stage_times.py <event-log-file-or-dir>``.
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    path = sys.argv[1]
    files = ([os.path.join(root, f) for root, _, names in sorted(os.walk(path))
              for f in sorted(names) if not f.startswith(("appstatus", "."))]
             if os.path.isdir(path) else [path])
    stats = defaultdict(lambda: defaultdict(float))
    stage_group: dict[int, str] = {}
    for f in files:
        for line in _lines(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
                stats[group]["jobs"] += 1
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                group = stage_group.get(info["Stage ID"], "-")
                stats[group]["stages"] += 1
                stats[group]["tasks"] += info.get("Number of Tasks", 0)
            elif kind == "SparkListenerTaskEnd":
                group = stage_group.get(ev.get("Stage ID"), "-")
                m = ev.get("Task Metrics") or {}
                stats[group]["task_ms"] += m.get("Executor Run Time", 0)
                sr = m.get("Shuffle Read Metrics") or {}
                sw = m.get("Shuffle Write Metrics") or {}
                stats[group]["shuffle_read_mb"] += (sr.get("Remote Bytes Read", 0)
                                                    + sr.get("Local Bytes Read", 0)) / 1e6
                stats[group]["shuffle_write_mb"] += sw.get("Shuffle Bytes Written", 0) / 1e6
                stats[group]["spill_mb"] += (m.get("Memory Bytes Spilled", 0)
                                             + m.get("Disk Bytes Spilled", 0)) / 1e6
    cols = ["jobs", "stages", "tasks", "task_ms", "shuffle_read_mb", "shuffle_write_mb", "spill_mb"]
    print("query".ljust(38) + "".join(c.rjust(17) for c in cols))
    for group, s in sorted(stats.items()):
        print(group[:37].ljust(38) + "".join(f"{s[c]:17.1f}" for c in cols))


if __name__ == "__main__":
    main()
