"""Summarise the executed physical plan of every registered query (manual tool).

Usage: python tests/plan_report.py [sf_dir] [name ...]

Runs each query (collect, small scale factor) so AQE plans are final, then counts shuffle
exchanges, broadcasts, joins by kind, aggregates by kind, windows, sorts,
whole-stage-codegen stages, and lists each scan's columns and pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))


def final_only(plan: str) -> str:
    """Drop the ``== Initial Plan ==`` sections AQE prints beside the final plan."""
    out, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :|"))
        if skip_indent is not None:
            if indent > skip_indent:
                continue
            skip_indent = None
        if "== Initial Plan ==" in line:
            skip_indent = indent
            continue
        out.append(line)
    return "\n".join(out)


def summarise(plan: str) -> dict:
    plan = final_only(plan)

    def n(pattern):
        return len(re.findall(pattern, plan))

    scans = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", plan):
        cols = [c for c in m.group(1).split(",") if c.strip()]
        pushed = m.group(2)
        scans.append(f"{len(cols)} cols" + (f", pushed {pushed[:60]}" if pushed else ""))
    joins = sorted(set(re.findall(r"(\w+HashJoin|SortMergeJoin|\w*NestedLoopJoin|CartesianProduct)", plan)))
    aggs = sorted(set(re.findall(r"(HashAggregate|ObjectHashAggregate|SortAggregate)", plan)))
    return {
        "shuffles": n(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobinPartitioning"),
        "single": n(r"Exchange SinglePartition"),
        "broadcasts": n(r"BroadcastExchange"),
        "joins": ", ".join(joins) or "-",
        "aggs": ", ".join(aggs) or "-",
        "windows": n(r"\bWindow(GroupLimit)? "),
        "codegen": n(r"WholeStageCodegen|\*\(\d+\)"),
        "python": "yes" if re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan) else "no",
        "scans": "; ".join(sorted(set(scans))) or "-",
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    from tvlens.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8)
    print("# Physical plans\n")
    print(
        f"Executed (final adaptive) plans of every registered query on `{sf}`, produced by "
        "`tests/plan_report.py`. *shuffles* counts hash/range exchanges, *single* single-partition "
        "exchanges (global aggregates, top-k merges, scalar subqueries, per-bucket offsets), *codegen* "
        "whole-stage-codegen operators; *python* says whether any Python worker runs.\n"
    )
    print("| query | shuffles | single | broadcasts | joins | aggregates | windows | codegen | python | scans |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    queries = entry.queries()
    for name in argv[2:] or queries:
        df = queries[name](spark, sf)
        df.collect()  # runs this DataFrame's own query execution, so its AQE plan is final
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(
            f"| {name} | {s['shuffles']} | {s['single']} | {s['broadcasts']} | {s['joins']} | {s['aggs']} | "
            f"{s['windows']} | {s['codegen']} | {s['python']} | {s['scans']} |"
        )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
