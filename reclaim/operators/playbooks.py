"""F. Playbook economics, experiment sizing and owner workload.

All of these start from the action queue (75 rows by default, or the
whole queue) and the four-row playbook dimension, which is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dims
from ..functions.bitmaps import distinct_ids
from ..functions.exprs import exact_sum, precise_avg, precise_sum, rnd
from .actions import issue_list

# Decision and sizing thresholds.
SCALE_NET = 1000.0
SCALE_ROI = 3.0
TEST_ROI = 1.5
MIN_ARM = 5
CONTROL_SHARE = 0.25
MIN_LIFT = 0.03
LIFT_FACTOR = 0.35
# speed_to_value label -> experiment duration (days); anything else 35.
DURATIONS = [("0-7 days", 14), ("7-14 days", 21), ("7-21 days", 28)]
DEFAULT_DURATION = 35


def explode_issues(queue: DataFrame, keep: tuple[str, ...] = ("customer_id", "brand")) -> DataFrame:
    """one row per (queue row, issue); the value is split equally."""
    issues = issue_list(queue)
    return queue.select(
        *keep,
        F.explode(issues).alias("issue_type"),
        (F.col("expected_value") / F.size(issues)).alias("allocated_value"),
    )


def decision_label(net, roi):
    """F4 on unrounded net impact and ROI."""
    return (
        F.when((net >= SCALE_NET) & (roi >= SCALE_ROI), "Scale this week")
        .when((net > 0) & (roi >= TEST_ROI), "Run controlled test")
        .when(net > 0, "Monitor economics")
        .otherwise("Do not scale yet")
    )


def playbook_roi(queue: DataFrame, made: DataFrame | None = None) -> DataFrame:
    """Per issue roll-up joined to its playbook; ranked by net
    impact then ROI.  Issues without a playbook are dropped.  Distinct customers
    come from the queue's customer bitmaps (``segments.customer_bitmaps``) where
    these are ``made``."""
    spark = queue.sparkSession
    distinct = [F.count_distinct("customer_id").alias("eligible_customers")] if made is None else []
    grouped = (
        explode_issues(queue)
        .groupBy("issue_type")
        .agg(
            *distinct,
            precise_sum("allocated_value").alias("gross_value"),
            precise_avg("allocated_value").alias("avg_customer_value"),
            F.array_join(F.array_sort(F.collect_set("brand")), ", ").alias("brands"),
        )
    )
    if made is not None:
        grouped = grouped.join(distinct_ids(made, ["issue_type"], "eligible_customers"), "issue_type")
    pb = F.broadcast(dims.playbooks(spark))
    j = grouped.join(pb, "issue_type")
    total_cost = F.col("eligible_customers") * F.col("cost_per_action")
    saved = F.col("gross_value") * F.col("expected_save_rate")
    econ = (
        j.withColumn("total_cost_raw", total_cost)
        .withColumn("saved_raw", saved)
        .withColumn("net_raw", F.col("saved_raw") - F.col("total_cost_raw"))
        .withColumn("roi_raw", F.try_divide(F.col("saved_raw"), F.nullif(F.col("total_cost_raw"), F.lit(0.0))))
    )
    out = econ.select(
        "issue_type",
        "playbook",
        "owner",
        F.col("eligible_customers").cast("long").alias("eligible_customers"),
        rnd("gross_value", 2).alias("gross_value"),
        rnd("avg_customer_value", 2).alias("avg_customer_value"),
        rnd("cost_per_action", 2).alias("cost_per_action"),
        rnd("total_cost_raw", 2).alias("total_cost"),
        rnd("expected_save_rate", 4).alias("expected_save_rate"),
        rnd("saved_raw", 2).alias("expected_saved_value"),
        rnd("net_raw", 2).alias("net_impact"),
        rnd("roi_raw", 2).alias("roi"),
        "speed_to_value",
        "primary_metric",
        "brands",
        decision_label(F.col("net_raw"), F.col("roi_raw")).alias("decision"),
    )
    # At most one row per playbook (four), so this window is tiny.
    order = Window.orderBy(F.col("net_impact").desc(), F.col("roi").desc_nulls_last(), F.col("issue_type"))
    return out.select(F.row_number().over(order).alias("rank"), *out.columns)


def _duration(speed):
    out = None
    for label, days in DURATIONS:
        out = F.when(speed == label, days) if out is None else out.when(speed == label, days)
    return out.otherwise(DEFAULT_DURATION)


def experiment_backlog(playbooks: DataFrame) -> DataFrame:
    """treatment/control sizes, detectable lift and duration."""
    spark = playbooks.sparkSession
    text = F.broadcast(dims.playbooks(spark).select("issue_type", "hypothesis", "decision_rule"))
    control = F.greatest(F.lit(MIN_ARM), F.rint(F.col("eligible_customers") * F.lit(CONTROL_SHARE)).cast("long"))
    return playbooks.join(text, "issue_type").select(
        F.format_string("EXP-%03d", F.col("rank")).alias("experiment_id"),
        "playbook",
        "owner",
        "hypothesis",
        F.greatest(F.lit(MIN_ARM), F.col("eligible_customers") - control).alias("treatment_count"),
        control.alias("control_count"),
        "primary_metric",
        rnd(F.greatest(F.lit(MIN_LIFT), F.col("expected_save_rate") * F.lit(LIFT_FACTOR)), 4).alias(
            "minimum_detectable_lift"
        ),
        _duration(F.col("speed_to_value")).alias("duration_days"),
        "decision_rule",
    )


def owner_workload(playbooks: DataFrame) -> DataFrame:
    """per owner totals and the playbook with the best net impact."""
    best = F.min_by(F.col("playbook"), F.struct((-F.col("net_impact")).alias("n"), F.col("issue_type").alias("i")))
    return (
        playbooks.groupBy("owner")
        .agg(
            F.count("playbook").alias("playbooks"),
            F.sum("eligible_customers").alias("eligible_customers"),
            rnd(exact_sum("gross_value"), 2).alias("gross_value"),
            rnd(exact_sum("total_cost"), 2).alias("total_cost"),
            rnd(exact_sum("net_impact"), 2).alias("expected_net_impact"),
            best.alias("best_next_playbook"),
        )
        .orderBy(F.col("expected_net_impact").desc(), F.col("owner"))
    )
