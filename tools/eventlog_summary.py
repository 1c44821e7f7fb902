"""Per-job-group stage and task time from a Spark event log (no UI needed).

    python tools/eventlog_summary.py <event_log_dir_or_file>

bench.py tags every timed step with a job group of the same name, so the
output lists, per step: jobs, stages, tasks, summed task time, shuffle bytes
written/read and input bytes.
"""

from __future__ import annotations

import collections
import json
import os
import sys


def events(path):
    """All events under ``path`` (a file, a log folder, or rolling ``eventlog_v2_*`` folders)."""
    if os.path.isdir(path):
        files = sorted(os.path.join(root, f) for root, _, names in os.walk(path) for f in names
                       if not f.startswith(("appstatus", ".")))
    else:
        files = [path]
    for f in files:
        if f.endswith(".zstd"):
            import io
            import zstandard
            with open(f, "rb") as raw:
                fh = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                lines = list(fh)
        else:
            with open(f, encoding="utf-8") as fh:
                lines = list(fh)
        for line in lines:
            if line.strip():
                yield json.loads(line)


def main(path: str) -> None:
    stage_group, job_group = {}, {}
    agg = collections.defaultdict(lambda: collections.Counter())
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
            job_group[e["Job ID"]] = group
            agg[group]["jobs"] += 1
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            group = stage_group.get(info["Stage ID"], "-")
            if "Completion Time" in info and "Submission Time" in info:
                agg[group]["stages"] += 1
                agg[group]["stage_ms"] += info["Completion Time"] - info["Submission Time"]
        elif kind == "SparkListenerTaskEnd":
            group = stage_group.get(e["Stage ID"], "-")
            m = e.get("Task Metrics") or {}
            agg[group]["tasks"] += 1
            agg[group]["task_ms"] += m.get("Executor Run Time", 0)
            agg[group]["shuffle_write_b"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            rd = m.get("Shuffle Read Metrics") or {}
            agg[group]["shuffle_read_b"] += rd.get("Remote Bytes Read", 0) + rd.get("Local Bytes Read", 0)
            agg[group]["input_b"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
    cols = ["jobs", "stages", "tasks", "stage_ms", "task_ms", "input_b", "shuffle_write_b", "shuffle_read_b"]
    print("| group | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for group, c in agg.items():
        print(f"| {group} | " + " | ".join(str(c[k]) for k in cols) + " |")


if __name__ == "__main__":
    main(sys.argv[1])
