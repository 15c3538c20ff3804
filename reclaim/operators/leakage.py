"""D. Revenue-leak detection.

One function per leak branch, each a projection/filter or a keyed join of
the scored customer table; the report collapses each branch to one row.
Customer-keyed joins are sort-merge joins on ``customer_id`` (both sides
are customer-sized); AQE splits a skewed key and turns a side into a
broadcast only when its measured size is small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dims
from ..functions.exprs import attach, exact_avg, exact_sum, max0, precise_avg, precise_sum, rnd, safe_div
from ..session import bounded
from .summaries import campaign_roi

DEFAULT_MARGIN = 0.48
MARGIN_MONTHS = 6
DISCOUNT_MONTHS = 3
MIN_DISCOUNT = 0.35
MIN_DISCOUNT_RISK = 0.30
RISK_FLOOR = 0.22
MIN_TICKETS = 3
MIN_SUPPORT_RISK = 0.35

CONTEXT = ["customer_id", "brand", "monthly_revenue", "churn_risk_score", "six_month_margin_at_risk"]


def brand_margins(skus: DataFrame) -> DataFrame:
    """Mean gross margin per brand (one row per brand)."""
    return (
        skus.where(F.col("brand").isNotNull())
        .groupBy("brand")
        .agg(exact_avg("gross_margin_rate").alias("brand_margin"))
    )


def margin_at_risk(scored: DataFrame, skus: DataFrame, default_margin: float = DEFAULT_MARGIN,
                   months: int = MARGIN_MONTHS) -> DataFrame:
    """Customers + brand margin (default when unknown) + the
    six-month margin at risk = revenue x months x margin x score.

    The margins are one row per brand: they are read at once (one job) and
    broadcast when their row count allows it, so customers are not shuffled
    onto a handful of brand keys."""
    margins = bounded(brand_margins(skus))
    enriched = scored.join(margins, "brand", "left").withColumn(
        "gross_margin_rate", F.coalesce(F.col("brand_margin"), F.lit(default_margin))
    )
    risk = F.col("monthly_revenue") * F.lit(months) * F.col("gross_margin_rate") * F.col("churn_risk_score")
    return enriched.drop("brand_margin").withColumn("six_month_margin_at_risk", risk).select(
        *scored.columns, "gross_margin_rate", "six_month_margin_at_risk"
    )


def open_failed_payments(payments: DataFrame, enriched: DataFrame) -> DataFrame:
    """D3: failed invoices with customer context (unknown customers kept).
    The status filter is applied below the join by the optimizer."""
    ctx = enriched.select(*CONTEXT)
    return payments.join(ctx, "customer_id", "left").where(F.col("payment_status") == "failed")


def late_orders(fulfillment: DataFrame, enriched: DataFrame) -> DataFrame:
    """Late orders with context, matched on customer and brand."""
    ctx = enriched.select(*CONTEXT)
    return fulfillment.join(ctx, ["customer_id", "brand"], "left").where(F.col("late_flag") == 1)


def discount_leak(enriched: DataFrame, min_discount: float = MIN_DISCOUNT, min_risk: float = MIN_DISCOUNT_RISK,
                  months: int = DISCOUNT_MONTHS) -> DataFrame:
    """Deep discounts on risky customers; leak = revenue x months x
    discount x margin."""
    leak = F.col("monthly_revenue") * F.lit(months) * F.col("discount_rate") * F.col("gross_margin_rate")
    return enriched.where(
        (F.col("discount_rate") >= min_discount) & (F.col("churn_risk_score") >= min_risk)
    ).withColumn("discount_margin_leak", leak)


def channel_quality(enriched: DataFrame) -> DataFrame:
    """Customers, mean risk and mean revenue per (brand, channel)."""
    return (
        enriched.where(F.col("brand").isNotNull() & F.col("acquisition_channel").isNotNull())
        .groupBy("brand", "acquisition_channel")
        .agg(
            F.count("customer_id").alias("acquired_customers"),
            exact_avg("churn_risk_score").alias("avg_churn_risk"),
            precise_avg("monthly_revenue").alias("avg_monthly_revenue"),
        )
    )


def weak_campaigns(campaigns: DataFrame, quality: DataFrame, risk_floor: float = RISK_FLOOR) -> DataFrame:
    """Campaigns whose payback gap or subscriber risk puts budget at
    risk.  Zero spend or no acquired customers -> NULL -> not kept."""
    joined = campaign_roi(campaigns).join(quality, ["brand", "acquisition_channel"], "left")
    out = (
        joined.withColumn("payback_gap", max0(F.lit(1.0) - F.col("roi")))
        .withColumn("quality_penalty", max0(F.col("avg_churn_risk") - F.lit(risk_floor)))
        .withColumn(
            "budget_at_risk",
            F.col("spend") * F.col("payback_gap") + F.col("spend") * F.col("quality_penalty"),
        )
    )
    return out.where(F.col("budget_at_risk") > 0)


def sku_risk(skus: DataFrame) -> DataFrame:
    """D8 (shared with H7): stockout units, risk share and margin at risk
    for every SKU, largest margin first."""
    short = F.greatest(F.lit(0), F.col("forecast_30d_units") - F.col("on_hand_units"))
    out = (
        skus.withColumn("stockout_units", short)
        .withColumn("stockout_risk", safe_div(F.col("stockout_units").cast("double"), F.col("forecast_30d_units")))
        .withColumn("margin_at_risk", F.col("stockout_units") * F.col("unit_price") * F.col("gross_margin_rate"))
    )
    return out.orderBy(F.col("margin_at_risk").desc(), F.col("sku").asc())


def inventory_risk(skus: DataFrame) -> DataFrame:
    return sku_risk(skus).where(F.col("stockout_units") > 0)


def support_escalation(enriched: DataFrame, min_tickets: int = MIN_TICKETS,
                       min_risk: float = MIN_SUPPORT_RISK) -> DataFrame:
    """Repeated tickets on risky customers."""
    return enriched.where((F.col("support_tickets_90d") >= min_tickets) & (F.col("churn_risk_score") >= min_risk))


def leakage_report(open_failed: DataFrame, late: DataFrame, discount: DataFrame, weak: DataFrame,
                   inventory: DataFrame, support: DataFrame) -> DataFrame:
    """Six area rows ranked by value then count.

    Each branch is one global aggregate (one row); ranking runs over the six
    rows only.
    """
    spark = open_failed.sparkSession

    def area(df: DataFrame, key: str, value: str, exact: bool = False) -> DataFrame:
        total = exact_sum(value) if exact else precise_sum(value)
        return df.agg(F.count(F.lit(1)).alias("affected_count"), rnd(total, 2).alias("revenue_at_risk")).select(
            F.lit(key).alias("area_key"), "affected_count", "revenue_at_risk"
        )

    parts = [
        area(open_failed, "payment", "invoice_amount", exact=True),
        area(late, "late", "six_month_margin_at_risk"),
        area(discount, "discount", "discount_margin_leak"),
        area(weak, "campaign", "budget_at_risk"),
        area(inventory, "inventory", "margin_at_risk"),
        area(support, "support", "six_month_margin_at_risk"),
    ]
    rows = reduce(DataFrame.unionByName, parts)
    text = F.broadcast(dims.leak_areas(spark))
    ranked = rows.join(text, "area_key")
    order = Window.orderBy(F.col("revenue_at_risk").desc(), F.col("affected_count").desc(), F.col("leak_area"))
    return ranked.select(
        F.row_number().over(order).alias("rank"),
        "leak_area",
        "problem",
        "affected_count",
        "revenue_at_risk",
        "recommended_action",
        "owner",
        "urgency",
    )


def payment_recovery(payments: DataFrame) -> DataFrame:
    """Declined invoices by reason with the still-open part.

    One conditional aggregate replaces a join of two roll-ups: open failed
    invoices are the ``failed`` subset of the declined ones.
    """
    failed = F.col("payment_status") == "failed"
    declined = payments.where(F.col("payment_status").isin("failed", "recovered") & F.col("decline_reason").isNotNull())
    return (
        declined.groupBy("decline_reason")
        .agg(
            F.count("invoice_id").alias("failed_invoices"),
            rnd(exact_sum("invoice_amount"), 2).alias("total_failed_amount"),
            F.count_if(failed & F.col("invoice_id").isNotNull()).alias("open_failed"),
            rnd(exact_sum(F.when(failed, F.col("invoice_amount"))), 2).alias("open_amount"),
        )
        .orderBy(F.col("open_amount").desc(), F.col("decline_reason"))
    )


def brief_items(report: DataFrame, items: int = 3) -> DataFrame:
    """The first ``items`` report rows, whole (part of D12)."""
    return report.where(F.col("rank") <= items).orderBy("rank")


def brief_record(report: DataFrame, items: int = 3) -> DataFrame:
    """D12 as it is written: the brief with its first areas as records."""
    record = F.struct(*[F.col(c) for c in report.columns])
    first = F.sort_array(F.collect_list(F.when(F.col("rank") <= items, record)))
    flat = weekly_brief(report, items).drop("leakage_items")
    return attach(flat, report.agg(first.alias("leakage_items")))


def weekly_brief(report: DataFrame, items: int = 3) -> DataFrame:
    """One row: total at risk, top area and action, number of "Today"
    areas, and the first ``items`` areas in rank order."""
    top = F.min_by(F.struct("leak_area", "recommended_action"), F.col("rank"))
    firsts = F.sort_array(F.collect_list(F.when(F.col("rank") <= items, F.struct("rank", "leak_area"))))
    return report.agg(
        rnd(exact_sum("revenue_at_risk"), 2).alias("total_revenue_at_risk"),
        top.getField("leak_area").alias("top_leak_area"),
        top.getField("recommended_action").alias("top_recommended_action"),
        F.count_if(F.col("urgency") == "Today").alias("today_actions"),
        F.array_join(F.transform(firsts, lambda s: s.getField("leak_area")), " | ").alias("leakage_items"),
    )
