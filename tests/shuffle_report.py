"""Bytes read vs shuffled per query, from Spark's event log (manual tool).

Usage: python tests/shuffle_report.py [sf_dir] >> PLANS.md

Runs every registered query once (noop sink) with the event log written to a
fresh scratch folder, tags each query's jobs with a job description, then
sums the task metrics per query: records read, shuffle bytes written, and
the largest shuffle-read bytes of a single task (skew signal).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tvlens-eventlog-")
    import __spark_entry__ as entry
    from tvlens.session import build_session

    spark = build_session(
        master="local[8]",
        shuffle_partitions=8,
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    sc = spark.sparkContext
    names = list(entry.queries())
    for name, fn in entry.queries().items():
        sc.setJobDescription(f"q:{name}")
        fn(spark, sf).write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    spark.stop()

    stage_query: dict[int, str] = {}
    metrics = defaultdict(lambda: {"in_bytes": 0, "in_rows": 0, "sh_write": 0, "max_task_sh_read": 0})
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                if not line.startswith("{"):
                    continue
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description") or ""
                    if desc.startswith("q:"):
                        for sid in ev.get("Stage IDs", []):
                            stage_query[sid] = desc[2:]
                elif kind == "SparkListenerTaskEnd":
                    q = stage_query.get(ev.get("Stage ID"))
                    tm = ev.get("Task Metrics") or {}
                    if not q:
                        continue
                    m = metrics[q]
                    im = tm.get("Input Metrics") or {}
                    m["in_bytes"] += im.get("Bytes Read", 0)
                    m["in_rows"] += im.get("Records Read", 0)
                    m["sh_write"] += (tm.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    rm = tm.get("Shuffle Read Metrics") or {}
                    read = rm.get("Remote Bytes Read", 0) + rm.get("Local Bytes Read", 0)
                    m["max_task_sh_read"] = max(m["max_task_sh_read"], read)

    print(f"\n## Bytes read and shuffled (`{sf}`)\n")
    print(
        "From Spark's event log (`tests/shuffle_report.py`): rows read from parquet (a table read twice "
        "counts twice), bytes written to shuffle files, and the largest shuffle input of a single task "
        "(the skew signal). Aggregates shuffle partial rows, not input rows.  At this size AQE coalesces "
        "each shuffle into one or two tasks (advisory partition size 64 MB), so the last column shows "
        "coalescing rather than skew here; on a cluster it is the number to watch.\n"
    )
    print("| query | rows read | shuffle written KB | largest task shuffle read KB |")
    print("|---|---|---|---|")
    for n in names:
        m = metrics.get(n)
        if not m:
            continue
        print(
            f"| {n} | {m['in_rows']:,} | {m['sh_write'] / 1e3:.1f} | {m['max_task_sh_read'] / 1e3:.1f} |"
        )


if __name__ == "__main__":
    main(sys.argv)
