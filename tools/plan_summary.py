"""Summarize the physical plan of every query of the library (markdown table).

usage: python tools/plan_summary.py [sf_dir] > PLANS.md

Counts exchanges, joins, window operators, Python nodes and parquet scans
(with the columns each scan reads) in the plan Spark would run.  AQE may
still change join strategies at run time from measured sizes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from clickspark.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    from clickspark.plans import queries
    print("# Physical plans\n")
    print(f"Generated by `tools/plan_summary.py` on `{sf_dir}` (initial AQE plans; "
          "queries that write intermediate tables show the plan after them).\n")
    print("| query | exchanges | joins | windows | python | scans (columns read) | pushed filters |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        ex = len(re.findall(r"Exchange (hash|range|single|round|shufflepart)", plan)) + \
            len(re.findall(r"Exchange SinglePartition", plan))
        joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                           r"BroadcastNestedLoopJoin|CartesianProduct)", plan)
        wins = len(re.findall(r"\bWindow \[", plan))
        py = len(re.findall(r"(MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|"
                            r"BatchEvalPython|MapInArrow)", plan))
        scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
        cols = "; ".join(sorted({", ".join(f.split(":")[0] for f in s.split(","))
                                 for s in scans}))
        filters = {f for x in re.findall(r"PushedFilters: \[(.*?)\](?:,|\n)", plan)
                   for f in re.findall(r"\w+\([^()]*(?:\([^()]*\))?[^()]*\)", x)
                   if not f.startswith("IsNotNull")}
        pushed = "; ".join(sorted(filters)) or "-"
        jsum = ", ".join(f"{j} x{joins.count(j)}" for j in sorted(set(joins))) or "-"
        print(f"| {name} | {ex} | {jsum} | {wins} | {py} | {cols} | {pushed} |")


if __name__ == "__main__":
    main(sys.argv[1:])
