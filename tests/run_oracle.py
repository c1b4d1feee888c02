"""Compare every registered query with its oracle SQL (manual tool).

Usage: python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

from oracle_check import compare, duck_connection  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from tvlens.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8, extra_conf={"spark.driver.memory": "8g"})
    qs = entry.queries()
    sqls = entry.oracle_sql()
    con = duck_connection(sf)
    bad = 0
    for name in names or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf)
            if name in sqls:
                probs = compare(df, con, sqls[name])
                status = "OK" if not probs else "FAIL"
            else:
                n = df.count()
                probs, status = [], f"ROWS-ONLY ({n} rows)"
        except Exception as exc:  # noqa: BLE001
            probs, status = [repr(exc)[:2000]], "ERROR"
        bad += status in ("FAIL", "ERROR")
        print(f"{name:32s} {status:10s} {time.time() - t:6.2f}s")
        for p in probs:
            print("    ", p[:3000])
    missing = [k for k in sqls if k not in qs]
    if missing:
        print("oracle keys without query:", missing)
    print("failures:", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
