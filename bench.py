"""Benchmark: headline queries on the warehouse at $BENCH_SF_DIR.

Each query is planned from the parquet files and executed to a no-op sink
(full computation, no driver-side collect).  The batch pipeline (all
reports, shared intermediates checkpointed once) is timed as well.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "input_customers",
    "churn_score_fixed",
    "classification_metrics",
    "churn_train_score",
    "revenue_forecast",
    "payment_recovery",
    "leakage_report",
    "action_queue",
    "action_queue_full",
    "playbook_roi",
    "segment_opportunity",
    "alert_list",
    "scenario_plan",
    "run_kpis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from reclaim.plans import pipeline
    from reclaim.plans.registry import queries
    from reclaim.session import local_session, materialize
    from reclaim.sources import tpch

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="reclaim-bench")
    registry = queries()
    # Warm-up: JVM start, first parquet footers, codegen caches.
    registry["payment_recovery"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        t = time.time()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t, 3)
    t = time.time()
    steps = pipeline.run(spark, tpch.load(spark, sf_dir, share=materialize))
    timings["pipeline_all_reports"] = round(time.time() - t, 3)
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_plus_pipeline_total",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
        "pipeline_steps": {k: round(v, 3) for k, v in steps.items() if not k.startswith("_")},
    }))


if __name__ == "__main__":
    main()
