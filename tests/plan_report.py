"""Write PLANS.md: physical-plan properties of every registered query.

    python tests/plan_report.py /root/testdata/sf0.01 > PLANS.md

Each query is executed (so adaptive execution has settled the final plan)
and its executed plan is scanned for the operators that matter at scale.
Shared intermediates that a compound query materializes (Parquet tables
under the checkpoint folder) appear as materialized-table reads; the plans
that build them are listed under ``margin_at_risk`` and ``action_items``.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COLUMNS = [
    ("shuffles", r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning)"),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("SMJ", r"SortMergeJoin"),
    ("BHJ", r"BroadcastHashJoin"),
    ("hash agg", r"\bHashAggregate\("),
    ("object agg", r"ObjectHashAggregate\("),
    ("sort agg", r"SortAggregate\("),
    ("windows", r"\bWindow \["),
    ("unpartitioned windows", r"\bWindow \[.*windowspecdefinition\(([^,()]* (ASC|DESC)|specifiedwindowframe)"),
    ("map-side window limit", r"WindowGroupLimit .*Partial"),
    ("warehouse scans", r"FileScan parquet(?!.*reclaim-tables)"),
    ("warehouse scans with pushed filters", r"FileScan parquet(?!.*reclaim-tables).*PushedFilters: \[[^\]]"),
    ("materialized-table reads", r"FileScan parquet.*reclaim-tables"),
    ("Python", r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)"),
    ("cartesian", r"(CartesianProduct|BroadcastNestedLoopJoin)"),
]


def main(argv: list[str]) -> None:
    from reclaim.plans.registry import queries
    from reclaim.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    # Show full file locations so reads of materialized tables can be told apart.
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tests/plan_report.py` on `{sf_dir}` (local[8], AQE on, final adaptive plans).")
    print("Counts are plan nodes. Unpartitioned windows only appear over bounded row sets (see README);")
    print("single-partition exchanges feed global one-row aggregates after map-side partial aggregation.\n")
    print("| query | " + " | ".join(c for c, _ in COLUMNS) + " |")
    print("|---|" + "---|" * len(COLUMNS))
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        counts = [sum(1 for line in lines if re.search(p, line)) for _, p in COLUMNS]
        print(f"| `{name}` | " + " | ".join(str(c) for c in counts) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
