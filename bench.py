"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (the whole plan
runs, nothing is collected).  One warm-up pass over every query, then
$BENCH_REPEAT timed passes; the per-query figure is the median.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from riskloom.plans import queries as Q  # noqa: E402
from riskloom.session import build_session  # noqa: E402

HEADLINE = [
    "daily_freshness", "quality_report_gaps", "row_profile", "validation_gate", "null_drop_report",
    "booking", "class_balance", "stratified_split", "dataset_profile", "score_table", "prediction_summary",
    "confusion", "class_report", "auc_ap", "roc_curve", "evaluation_metrics", "importance_rank",
    "training_extract", "table_stats", "accuracy_trend", "value_percentiles", "probability_percentiles",
    "error_rate_daily", "psi_total", "stream_scores", "stream_daily_monitor",
]


def run_once(spark, name, sf_dir):
    t0 = time.perf_counter()
    df = Q.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * cpus))))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=parts, app="riskloom-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    for n in names:  # warm-up: JIT, file listing, codegen caches
        run_once(spark, n, sf_dir)
    per = {}
    for n in names:
        per[n] = round(statistics.median(run_once(spark, n, sf_dir) for _ in range(repeat)), 4)
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(per.values()), 4), "unit": "sec",
                      "queries": per, "sf": sf, "cpus": cpus, "repeat": repeat}))


if __name__ == "__main__":
    main()
