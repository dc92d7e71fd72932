"""Summarise a Spark event log: wall time per job group and the slowest stages.

usage: python tools/stage_times.py <event log file or folder> [top_n]
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _open(path):
    if path.endswith(".zstd"):
        import io

        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
    return open(path)


def main():
    path = sys.argv[1]
    if os.path.isdir(path):  # rolling event log folder: events_<n>_<app> files
        files = sorted((f for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(f.split("_")[1]))
        lines = (ln for f in files for ln in _open(os.path.join(path, f)))
    else:
        lines = _open(path)
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stage_group, stages, jobs = {}, {}, defaultdict(lambda: [None, None, 0])
    for line in lines:
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
            g = jobs[group]
            g[0] = e["Submission Time"] if g[0] is None else min(g[0], e["Submission Time"])
            g[2] += 1
        elif ev == "SparkListenerJobEnd":
            pass
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Completion Time" in info and "Submission Time" in info:
                stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"],
                                            info["Stage Name"][:70], info["Number of Tasks"])
    per_group = defaultdict(float)
    for sid, (ms, _, _) in stages.items():
        per_group[stage_group.get(sid, "-")] += ms / 1000
    print("stage seconds per job group (stages may overlap):")
    for g, sec in sorted(per_group.items(), key=lambda kv: -kv[1]):
        print(f"  {g:28s} {sec:8.2f}  jobs={jobs[g][2]}")
    print(f"slowest {top} stages:")
    for sid, (ms, name, n) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"  stage {sid:5d} {ms / 1000:7.2f}s tasks={n:4d} {stage_group.get(sid, '-'):24s} {name}")


if __name__ == "__main__":
    main()
