"""K. Read-side queries over the produced reports (what the dashboard
shows), as parameterized DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dims
from ..functions.exprs import attach, exact_avg, exact_sum, lazy, precise_sum, rnd
from .actions import issue_list

ALL = "All"


def enrich_queue(queue: DataFrame) -> DataFrame:
    """K1: queue + primary issue with its owner, urgency and label."""
    spark = queue.sparkSession
    meta = F.broadcast(
        dims.issue_meta(spark).select(
            F.col("issue_type").alias("primary_issue"),
            F.col("owner").alias("m_owner"),
            F.col("urgency").alias("m_urgency"),
            F.col("issue_label").alias("m_label"),
        )
    )
    out = queue.withColumn("primary_issue", F.element_at(issue_list(queue), 1)).join(meta, "primary_issue", "left")
    return out.select(
        *queue.columns,
        "primary_issue",
        F.coalesce("m_owner", F.lit(dims.DEFAULT_OWNER)).alias("owner"),
        F.coalesce("m_urgency", F.lit(dims.DEFAULT_URGENCY)).alias("urgency"),
        F.coalesce("m_label", F.col("primary_issue")).alias("issue_label"),
    )


def filter_queue(enriched: DataFrame, owner: str | None = None, urgency: str | None = None) -> DataFrame:
    out = enriched
    if owner and owner != ALL:
        out = out.where(F.col("owner") == owner)
    if urgency and urgency != ALL:
        out = out.where(F.col("urgency") == urgency)
    return out


def queue_view(queue: DataFrame, owner: str | None = None, urgency: str | None = None, limit: int = 12) -> DataFrame:
    """K1-K2: the filtered queue's first ``limit`` rows (value order) and
    the number of rows matching the filter."""
    matched = filter_queue(enrich_queue(queue), owner, urgency)
    count = matched.agg(F.count(F.lit(1)).alias("matching_items"))
    top = matched.orderBy(F.col("expected_value").desc(), F.col("customer_id").asc()).limit(limit)
    return attach(top, count)


def queue_filters(queue: DataFrame) -> DataFrame:
    """K3: distinct non-empty owner and urgency filter values."""
    e = enrich_queue(queue)
    owners = e.select(F.lit("owner").alias("filter"), F.col("owner").alias("value"))
    urg = e.select(F.lit("urgency").alias("filter"), F.col("urgency").alias("value"))
    return owners.unionByName(urg).where(F.col("value").isNotNull() & (F.col("value") != "")).distinct()


def issue_mix(queue: DataFrame, owner: str | None = None, urgency: str | None = None) -> DataFrame:
    """K4: mentions per issue label in the filtered queue."""
    spark = queue.sparkSession
    matched = filter_queue(enrich_queue(queue), owner, urgency)
    labels = F.broadcast(dims.issue_meta(spark).select("issue_type", "issue_label"))
    exploded = matched.select(F.explode(issue_list(matched)).alias("issue_type"))
    return (
        exploded.join(labels, "issue_type", "left")
        .select(F.coalesce("issue_label", "issue_type").alias("issue_label"))
        .groupBy("issue_label")
        .agg(F.count(F.lit(1)).alias("mentions"))
        .orderBy(F.col("mentions").desc(), "issue_label")
    )


# Totals of each report that the headline is made of.
HEADLINE_TOTALS = {
    "payment_recovery": lambda: [F.coalesce(F.sum("open_failed"), F.lit(0)).alias("open_failed_payments")],
    "sku_risk": lambda: [rnd(precise_sum("margin_at_risk"), 2).alias("sku_exposure")],
    "headline_playbooks": lambda: [
        F.count(F.lit(1)).alias("playbooks"),
        exact_sum("net_impact").alias("net"),
        exact_sum("expected_saved_value").alias("saved"),
        exact_sum("total_cost").alias("cost"),
    ],
    "headline_queue": lambda: [F.count(F.lit(1)).alias("queue_items")],
}


def headline_kpis(payment_summary: DataFrame, skus: DataFrame, playbooks: DataFrame, queue: DataFrame, total=lazy) -> DataFrame:
    """K5-K6: one row of headline numbers; blended ROI = saved / cost.  Each
    report contributes its row of ``HEADLINE_TOTALS`` by ``total(df, name,
    metrics)``."""
    tables = {"payment_recovery": payment_summary, "sku_risk": skus, "headline_playbooks": playbooks, "headline_queue": queue}
    one, *parts = [total(df, name, HEADLINE_TOTALS[name]()) for name, df in tables.items()]
    for part in parts:
        one = attach(one, part)
    return one.select(
        "open_failed_payments",
        "sku_exposure",
        rnd("net", 2).alias("net_impact"),
        "queue_items",
        "playbooks",
        rnd("saved", 2).alias("expected_saved_value"),
        rnd("cost", 2).alias("total_cost"),
        F.when(F.col("cost") != 0, rnd(F.col("saved") / F.col("cost"), 4)).otherwise(0.0).alias("blended_roi"),
    )


def scenario_detail(plan: DataFrame, actions: DataFrame, scenario: str | None = None, limit: int = 8) -> DataFrame:
    """K7: the chosen scenario (else the best-ranked one) and its first
    ``limit`` selected actions by net impact."""
    pref = F.when(F.col("scenario") == F.lit(scenario), 0).otherwise(1) if scenario else F.lit(1)
    pick = plan.orderBy(pref, F.col("net_impact").desc(), F.col("scenario")).limit(1).select("scenario")
    sel = actions.join(F.broadcast(pick), "scenario")
    return sel.orderBy(F.col("net_impact").desc(), F.col("expected_value").desc(), F.col("customer_id")).limit(limit)


def segment_headline(segments: DataFrame) -> DataFrame:
    """K8: count, top value, top action rate, mean priority."""
    return segments.agg(
        F.count(F.lit(1)).alias("priority_segments"),
        F.coalesce(F.max("expected_value"), F.lit(0.0)).alias("top_segment_value"),
        F.coalesce(F.max("action_rate"), F.lit(0.0)).alias("top_action_rate"),
        F.coalesce(rnd(exact_avg("priority_score"), 1), F.lit(0.0)).alias("avg_priority_score"),
    )


def alert_headline(summary: DataFrame) -> DataFrame:
    """K9: open and critical alerts, healthy-check share, top owner."""
    return summary.select(
        "open_alerts",
        "critical_alerts",
        F.when(F.col("checks_run") > 0, rnd(F.col("healthy_checks") / F.col("checks_run"), 4))
        .otherwise(0.0)
        .alias("healthy_share"),
        F.coalesce("top_alert_owner", F.lit("None")).alias("top_owner"),
    )


def share_of_max(df: DataFrame, value: str, name: str = "share_of_max") -> DataFrame:
    """Each value relative to the column maximum (floor 1).  For
    reports of a few rows (leak areas, decline reasons, issues): the maximum
    comes from a window over them."""
    most = F.max(F.col(value).cast("double")).over(Window.partitionBy(F.lit(0)))
    return df.withColumn(name, F.col(value) / F.greatest(F.coalesce(most, F.lit(1.0)), F.lit(1.0)))


def top_skus(sku_report: DataFrame, limit: int = 8) -> DataFrame:
    """First SKUs of the margin-ordered stockout report."""
    return sku_report.orderBy(F.col("margin_at_risk").desc(), F.col("sku").asc()).limit(limit)


def top_issue_segments(matrix: DataFrame, limit: int = 6) -> DataFrame:
    """The first matrix rows, one row per issue with customers > 0."""
    first = matrix.orderBy(F.col("total_issue_mentions").desc(), "brand", "acquisition_channel", "plan").limit(limit)
    stacked = first.select(
        "segment_name",
        F.explode(F.array(*[F.struct(F.lit(i).alias("issue_type"), F.col(i).alias("customers")) for i in dims.ISSUES])).alias("c"),
    )
    return stacked.select("segment_name", "c.issue_type", "c.customers").where(F.col("customers") > 0)
