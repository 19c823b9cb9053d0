"""Print per-query plan statistics (exchanges, joins, windows, Python
stages, pushed filters) from the executed plans, without running them.

usage: python tools/plan_stats.py [sf_dir] [key ...]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

from propensia.plans.catalog import load_all  # noqa: E402
from propensia.session import build_session  # noqa: E402

SKIP = {"train_and_score", "feature_importance", "score_latest_model", "oversample_minority",
        "daily_ingest_stream", "scan_typed", "csv_staging_load", "table_roundtrip", "describe_table"}


def stats(plan: str) -> dict:
    lines = plan.splitlines()
    def count(pat):
        return sum(1 for ln in lines if re.search(pat, ln))
    return {
        "shuffle": count(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
        "bcast": count(r"BroadcastExchange"),
        "smj": count(r"SortMergeJoin"), "bhj": count(r"BroadcastHashJoin"),
        "nlj": count(r"BroadcastNestedLoopJoin|CartesianProduct"),
        "window": count(r"^\s*[:+\- ]*Window \["), "python": count(r"MapInPandas|ArrowEvalPython|BatchEvalPython"),
        "single": count(r"SinglePartition"),
        "pushed": count(r"PushedFilters: \[[^\]]+\]"),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = build_session("local[8]", 8)
    for key, q in load_all().items():
        if (keys and key not in keys) or (not keys and key in SKIP):
            continue
        df = q.build(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"{key:28s} {stats(plan)}")


if __name__ == "__main__":
    main()
