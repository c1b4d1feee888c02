"""Benchmark: run the registered queries on one scale factor, print one JSON line.

Environment:
  BENCH_SF_DIR   folder with the driver parquet tables (default /root/testdata/sf0.1)
  BENCH_CPUS     local[N] threads (default 8)
  BENCH_QUERIES  optional comma-separated subset of query names

Each query is executed completely with the ``noop`` sink (all rows are
produced, none are shipped to the driver).  The first dashboard query of a
folder also writes the tables it reads (plans/stored.py).  ``value`` is the sum of the
headline (analytics and serving) query times; every query's time is listed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)



def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    subset = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tvlens.plans import catalog
    from tvlens.session import build_session

    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=max(cpus, 8),
        app_name="tvlens-bench",
        extra_conf={"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)},
    )
    queries = catalog.registered()
    headline = set(catalog.GOLD) | set(catalog.SERVING)
    names = subset or list(queries)

    # Warm-up: every query once on the smallest folder next to the measured
    # one (JVM JIT of scan, aggregate, join and window code paths); not timed.
    # The timed runs below still list, read and compute their own data.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in names:
        queries[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(t for n, t in times.items() if n in headline), 3)
    print(
        json.dumps(
            {
                "metric": "analytics_total_sec",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "all_queries_sec": round(sum(times.values()), 3),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
