"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row produced, nothing
collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_split_counts",
    "base_table_left_joins",
    "key_match_rate",
    "wide_shares_trend",
    "column_catalog",
    "null_profile",
    "numeric_summary",
    "duplicate_grain",
    "quantile_clip",
    "target_correlation",
    "perfect_leak",
    "auc_ks_ap",
    "threshold_metrics",
    "decision_counts",
    "score_quantiles",
    "topk_scores",
    "trailing_features",
    "threshold_policy",
    "forest_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from abtforge.plans.registry import queries
    from abtforge.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    # Warm-up on the smallest data set: JIT and generated-code caches are filled the way
    # they are in a long-running cluster session; timings below are steady-state runs.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    # the median of three runs; queries of over 20 s run once (the forest job)
    times = {}
    for name in names:
        runs = []
        while len(runs) < 3 and not (runs and runs[0] > 20):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
