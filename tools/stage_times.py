"""Slowest stages from a Spark event log (written with BENCH_EVENTLOG=<dir> python bench.py).

    python tools/stage_times.py <event log file or directory> [top]
"""

from __future__ import annotations

import json
import os
import sys


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = [path]
    if os.path.isdir(path):  # Spark 4 writes a rolling log directory: events_<n>_<app> files
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    stages = []
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard

            fh = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
        else:
            fh = open(f)
        for line in fh:
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stages.append((end - start, info["Stage ID"], info.get("Number of Tasks"), info.get("Stage Name", "")[:90]))
        fh.close()
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms / 1000:8.2f}s  stage {sid:5d}  tasks {tasks:5d}  {name}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f}s total")


if __name__ == "__main__":
    main()
