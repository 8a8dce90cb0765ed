"""Summarise the executed physical plan of each registered query.

Usage: python tools/plan_report.py [sf_dir] [name ...]
Per query: Parquet scans, shuffles, join strategies, windows, and windows
fed by a single-partition exchange (one task) — each such window must sit
on a table whose size is bounded by construction.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.plans.registry import QUERIES  # noqa: E402
from riskloom.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    single_windows = 0
    for i, ln in enumerate(lines):
        if "Window [" in ln or re.search(r"\bWindow\b", ln):
            for nxt in lines[i + 1:i + 4]:
                if "SinglePartition" in nxt:
                    single_windows += 1
                    break
    return {
        "scans": len(re.findall(r"\b(?:File)?Scan parquet\b", plan)),
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "single": plan.count("Exchange SinglePartition"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "bnlj": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "windows": len(re.findall(r"\bWindow\b", plan)),
        "single_windows": single_windows,
        "python": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython") + plan.count("FlatMapGroupsInPandas"),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or [n for n in QUERIES if not n.startswith("ensemble_")]
    spark = build_session(extra={"spark.sql.adaptive.enabled": "false"})
    print(f"{'query':30s} scans shuf single bhj smj bnlj win win1 py")
    for n in names:
        df = QUERIES[n](spark, sf_dir)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"{n:30s} {s['scans']:5d} {s['shuffles']:4d} {s['single']:6d} {s['bhj']:3d} {s['smj']:3d} "
              f"{s['bnlj']:4d} {s['windows']:3d} {s['single_windows']:4d} {s['python']:2d}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
