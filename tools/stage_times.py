"""Summarise a Spark event log: jobs, stages and the slowest stages.

usage: python tools/stage_times.py EVENT_LOG_DIR_OR_FILE [top]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main():
    target = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    if os.path.isdir(target):
        files = sorted(f for f in glob.glob(os.path.join(target, "**", "events_*"), recursive=True))
    else:
        files = [target]
    stages, jobs = [], 0
    for f in files:
        for raw in _lines(f):
            ev = json.loads(raw)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                jobs += 1
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                if start and end:
                    scopes = []
                    for rdd in info.get("RDD Info", []):
                        name = json.loads(rdd["Scope"])["name"] if rdd.get("Scope") else rdd.get("Name", "")
                        if name and name not in scopes:
                            scopes.append(name)
                    stages.append((end - start, info["Stage ID"], info["Number of Tasks"], " / ".join(scopes)[:110]))
    total = sum(s[0] for s in stages)
    print(f"jobs={jobs} stages={len(stages)} stage_ms_total={total}")
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms:8d} ms  stage {sid:5d}  tasks {tasks:5d}  {name}")


if __name__ == "__main__":
    main()
