"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is fully executed into Spark's no-op sink (nothing is collected),
timed with wall clock, and one JSON line is printed:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from propensia.plans.catalog import load_all  # noqa: E402
from propensia.session import build_session  # noqa: E402

HEADLINE = [
    "internet_features", "tv_features", "journey_features", "mobile_features", "socio_features",
    "assemble_training", "assemble_scoring", "label_next_month", "propensity_label",
    "score_tiles", "lift_table", "report_lift", "report_auc", "roc_auc", "threshold_sweep",
    "classification_report", "customers_upsert", "fact_customer_star", "summary_stats",
    "daily_ingest_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": "16g"})
    reg = load_all()
    # warm-up on the smallest fixtures: JVM classes, Python (Arrow) workers
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for key in ("anchor_date", "score_tiles"):
        reg[key].build(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for key in (only or HEADLINE):
        t0 = time.perf_counter()
        df = reg[key].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
        print(f"# {key}: {times[key]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
