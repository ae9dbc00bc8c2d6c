"""Summarise the final adaptive plans of the headline queries into PLANS.md:
exchanges, join strategies, scans with their columns and pushed filters."""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(df):
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # run, so the adaptive plan is final
    node = qe.executedPlan()
    try:
        node = node.executedPlan()  # the final adaptive plan only, without AQE's initial plan
    except Exception:  # noqa: BLE001 (not adaptive)
        pass
    plan = node.toString()
    joins = {k: plan.count(k) for k in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                                        "BroadcastNestedLoopJoin", "CartesianProduct")}
    shuffles = len(re.findall(r"ShuffleQueryStage", plan))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    pushed = sorted(set(f for f in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if f))
    return shuffles, joins, scans, pushed


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from tramline import registry
    from tramline.session import build_session
    spark = build_session("tramline-plans", master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    lines = ["# Final adaptive plans of the headline queries", "",
             f"Input: `{sf}`, local[8], 16 shuffle partitions, AQE on. Generated by `tools/plans.py`.", "",
             "| query | shuffle stages | BHJ | SMJ | SHJ | nested loop | cartesian | parquet scans (max columns) | pushed filters |",
             "|---|---|---|---|---|---|---|---|---|"]
    for name in (n for n in HEADLINE if n in registry.queries()):
        s, j, scans, pushed = summarise(registry.queries()[name](spark, sf))
        widest = max((len(x.split(",")) for x in scans), default=0)
        lines.append(f"| {name} | {s} | {j['BroadcastHashJoin']} | {j['SortMergeJoin']} | {j['ShuffledHashJoin']} | "
                     f"{j['BroadcastNestedLoopJoin']} | {j['CartesianProduct']} | {len(scans)} ({widest}) | "
                     f"{'; '.join(p[:60] for p in pushed[:2])} |")
    lines += ["", "Shuffle stages include those of small sides (dimensions, places and events by hour, aggregates) that AQE "
              "then broadcasts.", ""]
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write(
        "\n".join(lines))
    print("\n".join(lines))


if __name__ == "__main__":
    main()
