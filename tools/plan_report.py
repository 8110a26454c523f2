"""Write PLANS.md: the physical-plan shape of each registered query at a given scale.

For every query: exchanges (and why), joins by strategy, Window operators, parquet scans with
their pushed filters. Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    ex = re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\)|RoundRobinPartitioning\(\d+\))[^\n]*?(ENSURE_REQUIREMENTS|REPARTITION_BY_NUM|REPARTITION_BY_COL)?", plan)
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)))
    return {
        "exchanges": [f"{e[0][:60]} {e[1]}".strip() for e in ex],
        "broadcast_exchanges": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"), "bhj": plan.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "scans": len(re.findall(r"FileScan parquet", plan)),
        "python": sum(plan.count(n) for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                                               "FlatMapGroupsInPandas")),
        "cross": sum(plan.count(n) for n in ("CartesianProduct", "BroadcastNestedLoopJoin")),
        "reused": plan.count("ReusedExchange"),
        "pushed": [p for p in pushed if p],
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from metricwatch.session import get_spark
    from metricwatch.plans.queries import QUERIES
    spark = get_spark()
    print(f"# Physical plans ({sf_dir}, after execution with AQE)\n")
    print("| query | shuffle exchanges | reused exchanges | broadcast | SMJ | BHJ | Window ops | parquet scans "
          "| Python nodes | cross joins |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    details = []
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()  # run through this DataFrame's own execution so the final AQE plan is shown
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        s = summarize(plan)
        print(f"| {name} | {len(s['exchanges'])} | {s['reused']} | {s['broadcast_exchanges']} | {s['smj']} | {s['bhj']} | "
              f"{s['windows']} | {s['scans']} | {s['python']} | {s['cross']} |")
        details.append((name, s))
    print("\n## Exchanges and pushed filters per query\n")
    for name, s in details:
        print(f"### {name}\n")
        for e in s["exchanges"]:
            print(f"* exchange: `{e}`")
        for p in s["pushed"]:
            print(f"* pushed: `{p[:200]}`")
        print()


if __name__ == "__main__":
    main()
