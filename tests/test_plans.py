"""Plan shape at scale: filters and column lists reach the scans, no
Python in the plan, no cartesian products, and the only unpartitioned
windows are over bounded inputs."""

import re

import pytest

from reclaim.plans import registry

from conftest import SF_SMALL


def plan(spark, name):
    df = registry.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_pushdown_and_pruning(spark):
    p = plan(spark, "input_customers")
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p
    assert "LessThan(o_orderdate" in p
    # lineitem is read with only the columns the adapter needs
    scan = next(line for line in p.splitlines() if "FileScan" in line and "lineitem.parquet" in line)
    cols = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
    assert {c.split("#")[0] for c in cols.split(",")} == {
        "l_orderkey", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"}


@pytest.mark.parametrize("name", ["leakage_report", "action_queue", "segment_opportunity", "alert_list",
                                  "scenario_plan", "run_kpis"])
def test_no_python_no_cartesian(spark, name):
    p = plan(spark, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


def test_scenario_window_is_partitioned(spark):
    p = plan(spark, "scenario_actions")
    assert re.search(r"Window \[row_number\(\).*\[scenario#\d+, owner#\d+\]", p)


def test_brand_margin_does_not_shuffle_customers_by_brand(spark):
    from pyspark.sql import functions as F

    from reclaim.operators import leakage

    # SKU data whose static size estimate is far over the broadcast threshold.
    skus = spark.range(2_000_000).select(
        F.concat(F.lit("brand"), F.col("id") % 5).alias("brand"), (F.col("id") % 35 / 100).alias("gross_margin_rate"))
    scored = spark.range(1_000_000).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("brand"), F.col("id") % 6).alias("brand"),
        F.lit(10.0).alias("monthly_revenue"), F.lit(0.5).alias("churn_risk_score"))
    out = leakage.margin_at_risk(scored, skus)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "hashpartitioning(brand" not in p
    assert out.where("brand = 'brand5' AND gross_margin_rate <> 0.48").count() == 0


def test_queue_context_leaves_the_broadcast_to_the_measured_size(spark):
    p = plan(spark, "segment_opportunity_full")
    assert "CartesianProduct" not in p
