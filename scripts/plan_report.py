"""Summarise the physical plan of every registered query into PLANS.md.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md
Counts shuffles, join strategies and aggregate operators, and lists the
filters and columns pushed into each parquet scan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowmart.plans import queries as Q  # noqa: E402
from flowmart.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    ops = re.findall(r"(?:\+- |:- |^)\*?(?:\(\d+\) )?([A-Za-z]+(?:Join|Aggregate|Exchange|Window|Generate))", plan, re.M)
    counts: dict[str, int] = {}
    for o in ops:
        counts[o] = counts.get(o, 0) + 1
    scans = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\(\d+ paths\)\[file:[^\]]*/(\w+)\.parquet\].*?PushedFilters: \[([^\]]*)\]", plan):
        cols, table, pushed = m.group(1), m.group(2), m.group(3)
        ncols = len([c for c in cols.split(",") if c.strip()])
        scans.append(f"{table}({ncols} cols{'; ' + pushed[:80] if pushed else ''})")
    return {"ops": counts, "scans": scans}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/plan_report.py` at `{sf_dir}` (initial AQE plans; AQE may turn a")
    print("sort-merge join into a broadcast join at run time).\n")
    print("| query | shuffles | joins | aggregates | other | parquet scans (columns read; pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in Q.queries().items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        ops = s["ops"]
        shuffles = sum(plan.count(f"Exchange {kind}")
                       for kind in ("hashpartitioning", "SinglePartition", "rangepartitioning",
                                    "RoundRobinPartitioning"))
        joins = ", ".join(f"{k} x{v}" for k, v in ops.items() if k.endswith("Join"))
        aggs = ", ".join(f"{k} x{v}" for k, v in ops.items() if k.endswith("Aggregate"))
        other = ", ".join(f"{k} x{v}" for k, v in ops.items()
                          if k.endswith("Window") or k.endswith("Generate")
                          or k == "BroadcastExchange")
        print(f"| {name} | {shuffles} | {joins or '-'} | {aggs or '-'} | {other or '-'} | "
              f"{'; '.join(s['scans']) or '-'} |")
    spark.stop()


if __name__ == "__main__":
    main()
