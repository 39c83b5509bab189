"""Physical shape of the headline queries with broadcast joins off (as for 100 TB inputs).

    python tools/plan_shapes.py [sf_dir]

Counts shuffles (Exchange), reused shuffles, sort-merge joins, window operators and
range partitionings in the executed plan of each query; prints a Markdown table.
"""

from __future__ import annotations

import sys

sys.path.insert(0, ".")

from bench import HEADLINE  # noqa: E402

from abtforge.plans.registry import queries  # noqa: E402
from abtforge.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_spark()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    qs = queries()
    print("| query | shuffles | reused | sort-merge joins | windows | range partitionings |")
    print("|---|---|---|---|---|---|")
    for name in HEADLINE:
        if name == "forest_scores":
            continue
        plan = qs[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        count = lambda s: sum(1 for l in lines if s in l)
        shuffles = sum(1 for l in lines if "Exchange hashpartitioning" in l or "Exchange rangepartitioning" in l
                       or "Exchange SinglePartition" in l or "Exchange RoundRobin" in l)
        print(f"| {name} | {shuffles} | {count('ReusedExchange')} | {count('SortMergeJoin')} | "
              f"{count('Window [')} | {count('rangepartitioning')} |")


if __name__ == "__main__":
    main()
