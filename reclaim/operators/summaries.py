"""C. Brand and channel summaries, revenue forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import attach, exact_avg, exact_sum, lazy, precise_sum, rnd, safe_div

FORECAST_PERIODS = 6
BAND_WIDTH = 1.15


def brand_summary(scored: DataFrame) -> DataFrame:
    """Per brand customers, revenue, churn rate, mean risk, tickets."""
    return (
        scored.where(F.col("brand").isNotNull())
        .groupBy("brand")
        .agg(
            F.count("customer_id").alias("customers"),
            rnd(precise_sum("monthly_revenue"), 2).alias("monthly_revenue"),
            rnd(F.avg("churned"), 4).alias("churn_rate"),
            rnd(exact_avg("churn_risk_score"), 4).alias("avg_risk_score"),
            F.sum("support_tickets_90d").alias("support_tickets_90d"),
            exact_avg("churn_risk_score").alias("raw_risk"),
        )
        .orderBy(F.col("raw_risk").desc(), F.col("brand"))
        .drop("raw_risk")
    )


def campaign_roi(campaigns: DataFrame) -> DataFrame:
    """Campaign return on spend; zero spend -> NULL (shared by C2, D7, H4)."""
    return campaigns.withColumn("roi", safe_div(F.col("attributed_revenue") - F.col("spend"), F.col("spend")))


def channel_summary(campaigns: DataFrame) -> DataFrame:
    """Campaigns + ROI (3 digits) + cost per conversion (2 digits)."""
    out = campaign_roi(campaigns)
    return out.select(
        *campaigns.columns,
        rnd("roi", 3).alias("roi"),
        rnd(safe_div(F.col("spend"), F.col("conversions")), 2).alias("cost_per_conversion"),
    )


def revenue_forecast(monthly: DataFrame, periods: int = FORECAST_PERIODS, band: float = BAND_WIDTH) -> DataFrame:
    """Per brand, least-squares line on the ordinal month index, then
    ``periods`` months ahead with a +-band x residual std interval.

    Series are per brand (one row per month), so each brand's window holds
    one row per calendar month regardless of data volume.  A brand with a
    single month has no slope: its forecast is NULL.
    """
    series = monthly.where(F.col("brand").isNotNull()).select("brand", "month", "subscription_revenue")
    by_brand = Window.partitionBy("brand")
    x = (F.row_number().over(by_brand.orderBy("month")) - 1).cast("double")
    y = F.col("subscription_revenue")
    fitted = (
        series.withColumn("x", x)
        .withColumn("slope", F.regr_slope(y, F.col("x")).over(by_brand))
        .withColumn("intercept", F.regr_intercept(y, F.col("x")).over(by_brand))
    )
    fit = fitted.groupBy("brand").agg(
        F.first("slope").alias("slope"),
        F.first("intercept").alias("intercept"),
        F.count(F.lit(1)).alias("n"),
        F.max("month").alias("last_month"),
        F.stddev_pop(y - (F.col("slope") * F.col("x") + F.col("intercept"))).alias("resid_std"),
    )
    step = F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step")
    ahead = fit.select("*", step)
    point = F.col("slope") * (F.col("n") + F.col("step") - 1).cast("double") + F.col("intercept")
    spread = F.lit(band) * F.col("resid_std")
    return ahead.select(
        F.add_months("last_month", F.col("step")).alias("month"),
        "brand",
        rnd(point, 2).alias("forecast_revenue"),
        rnd(point - spread, 2).alias("lower_bound"),
        rnd(point + spread, 2).alias("upper_bound"),
    )


# Totals of each table and report that the KPIs are made of.
KPI_TOTALS = {
    "kpi_customers": lambda: [
        F.count(F.lit(1)).alias("rows_processed"),
        rnd(F.avg("churned"), 4).alias("overall_churn_rate"),
        rnd(precise_sum("monthly_revenue"), 2).alias("total_monthly_revenue"),
    ],
    "quality_gates": lambda: [
        F.count_if("passed").alias("validation_checks_passed"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("passed"), F.col("check")))), ", ").alias("validation_checks"),
    ],
    "leakage_report": lambda: [
        rnd(exact_sum("revenue_at_risk"), 2).alias("total_revenue_at_risk"),
        F.count(F.lit(1)).alias("leakage_categories"),
    ],
    "queue": lambda: [F.count(F.lit(1)).alias("action_queue_items")],
    "playbook_roi": lambda: [
        rnd(exact_sum("net_impact"), 2).alias("playbook_net_impact"),
        F.count(F.lit(1)).alias("playbooks_recommended"),
    ],
    "experiment_backlog": lambda: [F.count(F.lit(1)).alias("experiments_ready")],
    "segment_opportunity": lambda: [
        F.count(F.lit(1)).alias("priority_segments"),
        F.coalesce(F.max("expected_value"), F.lit(0.0)).alias("top_segment_expected_value"),
    ],
    "scenario_plan": lambda: [
        F.coalesce(rnd(F.max("net_impact"), 2), F.lit(0.0)).alias("scenario_max_net_impact"),
        F.coalesce(F.max("selected_actions"), F.lit(0)).alias("scenario_max_actions"),
    ],
}


def run_kpis(customers: DataFrame, gates: DataFrame, report: DataFrame, queue: DataFrame, playbooks: DataFrame,
             experiments: DataFrame, opportunities: DataFrame, scenarios: DataFrame, monitor: DataFrame,
             metrics: DataFrame, total=lazy) -> DataFrame:
    """C4: the run's headline numbers, the ten model metrics and the names of
    the passed gates in one row.  Every table and report contributes its row
    of ``KPI_TOTALS`` by ``total(df, name, metrics)``: a plan, or what was
    observed when it was written."""
    tables = {"kpi_customers": customers, "quality_gates": gates, "leakage_report": report, "queue": queue,
              "playbook_roi": playbooks, "experiment_backlog": experiments, "segment_opportunity": opportunities,
              "scenario_plan": scenarios}
    one, *parts = [total(df, name, KPI_TOTALS[name]()) for name, df in tables.items()]
    monitor = monitor.select(F.col("open_alerts").alias("open_monitoring_alerts"), F.col("critical_alerts").alias("critical_monitoring_alerts"))
    # The metrics are one row already.
    model = total(metrics, "kpi_model", [F.first(c).alias(c) for c in metrics.columns])
    for part in [*parts, monitor, model]:
        one = attach(one, part)
    return one


MODEL_METRICS = [
    "accuracy", "precision", "recall", "f1", "roc_auc", "decision_threshold",
    "true_positives", "true_negatives", "false_positives", "false_negatives",
]


def kpi_record(kpis: DataFrame) -> DataFrame:
    """C4 as it is written: model metrics nested, gate names as a list."""
    flat = [c for c in kpis.columns if c not in MODEL_METRICS and c != "validation_checks"]
    return kpis.select(
        F.struct(*MODEL_METRICS).alias("model"), *flat, F.split("validation_checks", ", ").alias("validation_checks")
    )
