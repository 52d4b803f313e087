"""Per-stage task statistics of catalogue queries, read from Spark's event log.

    python scripts/stage_times.py [sf_dir] key [key ...]

Runs each query with the event log written to a fresh scratch folder (mktemp), then prints,
per stage: task count, median and max task duration, max / median ratio (skew), and the
largest shuffle read of one task. No web UI or REST endpoint is used.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from firmlens import catalog  # noqa: E402
from firmlens.session import tune  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    keys = [a for a in args if not a.startswith("/")] or ["sector_growth_top5"]
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]").appName("firmlens-stages")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    sc = spark.sparkContext
    for k in keys:
        sc.setJobGroup(k, k)
        catalog.QUERIES[k](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()

    tasks: dict[int, list[tuple[int, int]]] = {}
    stage_group: dict[int, str] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "?")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    info, metrics = ev["Task Info"], ev.get("Task Metrics") or {}
                    dur = info["Finish Time"] - info["Launch Time"]
                    sr = metrics.get("Shuffle Read Metrics") or {}
                    read = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                    tasks.setdefault(ev["Stage ID"], []).append((dur, read))
    print(f"{'query':28s} {'stage':>5s} {'tasks':>5s} {'med ms':>7s} {'max ms':>7s} {'skew':>5s} {'max shuffle read':>16s}")
    for sid in sorted(tasks):
        d = [t[0] for t in tasks[sid]]
        med = statistics.median(d)
        skew = max(d) / med if med else float("nan")
        print(f"{stage_group.get(sid, '?'):28s} {sid:5d} {len(d):5d} {med:7.0f} {max(d):7.0f} {skew:5.1f} "
              f"{max(t[1] for t in tasks[sid]):16d}")


if __name__ == "__main__":
    main()
