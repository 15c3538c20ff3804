"""Named queries: each takes (spark, warehouse folder) and returns the
DataFrame of one operator, computed over the whole warehouse."""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import churn, history, leakage, monitoring, quality, scenarios, summaries, views
from ..session import configure, ensure_checkpoint_dir, materialize, materialize_by_key
from ..sources import io, schemas
from ..sources.tpch import Dates
from .graph import Graph

Query = Callable[[SparkSession, str], DataFrame]


ALL_INPUTS = ("customers", "monthly_revenue", "campaigns", "payment_events", "fulfillment_events", "sku_inventory")

# Inputs a query's plan reads more than once (materialized once instead).
REUSED_INPUTS = {
    "run_kpis": ALL_INPUTS,
    "monitoring_summary": ALL_INPUTS,
    "alert_headline": ALL_INPUTS,
    "leakage_report": ("sku_inventory",),
    "weekly_brief": ("sku_inventory",),
    "leak_share": ("sku_inventory",),
    "headline_kpis": ("sku_inventory", "payment_events"),
    "classification_metrics": ("customers",),
    # Customer-keyed tables that are joined: written by customer.
    "open_failed_payments": ("payment_events",),
    "late_orders": ("fulfillment_events",),
    "action_items": ("payment_events", "fulfillment_events"),
}
BY_KEY = {"open_failed_payments", "late_orders", "action_items"}


def _graph(spark: SparkSession, sf_dir: str, shared: bool = True, name: str = "", **kw) -> Graph:
    """The operator graph over one warehouse folder.  With ``shared``, the
    intermediates used by several operators (and the inputs listed in
    ``REUSED_INPUTS`` for this query) are written once to the checkpoint
    folder instead of being re-derived from the warehouse at every use."""
    configure(spark)
    kw.setdefault("pin_inputs", REUSED_INPUTS.get(name, ()))
    by_key = materialize_by_key if name in BY_KEY else None
    return Graph.from_warehouse(spark, sf_dir, pin=materialize if shared else None, pin_by_key=by_key, **kw)


def _attr(name: str, qname: str = "", **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # A query whose result is the queue itself has nothing to share it with.
        kw.setdefault("pin_queue", name != "queue")
        return getattr(_graph(spark, sf_dir, shared=name not in SINGLE_USE, name=qname, **kw), name)

    run.__name__ = name
    return run


# Queries whose plan uses each intermediate once: nothing to share.
SINGLE_USE = {
    "scored", "brand_summary", "channel_summary", "revenue_forecast", "enriched",
    "discount_leak", "channel_quality", "weak_campaigns", "sku_risk", "support_leak", "payment_recovery",
    "base_segments", "campaign_alerts", "payment_alerts",
    "fulfillment_alerts", "inventory_alerts", "quality_gates", "metric_changes", "revenue_alerts", "churn_alerts",
}


def _input(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _graph(spark, sf_dir, shared=False).inputs[table]

    return run


def _f1(spark, sf_dir):
    return churn.best_threshold(_graph(spark, sf_dir, shared=False).holdout)


def _metrics(spark, sf_dir):
    # The hold-out feeds both the sweep and the AUC: share it.
    return _graph(spark, sf_dir, name="classification_metrics", pin_reports=("holdout",)).model_metrics


def _auc(spark, sf_dir):
    return churn.roc_auc(_graph(spark, sf_dir, shared=False).holdout)


def _top_risk(spark, sf_dir):
    return churn.top_risk(_graph(spark, sf_dir, shared=False).scored)


def _train_score(spark, sf_dir):
    return churn.churn_train_score(_written_customers(spark, sf_dir))


def _drivers(spark, sf_dir):
    return churn.model_drivers(_written_customers(spark, sf_dir))


def _auc_histogram(spark, sf_dir):
    return churn.roc_auc_histogram(_graph(spark, sf_dir, shared=False).holdout)


def _features(spark, sf_dir):
    return churn.feature_table(_written_customers(spark, sf_dir))


def _stationarity(spark, sf_dir):
    return churn.stationarity(_written_customers(spark, sf_dir))


def _written_customers(spark, sf_dir):
    """The customer table, written once: training reads it many times."""
    return _graph(spark, sf_dir, pin_inputs=("customers",)).customers


def _run_kpis(spark, sf_dir):
    return _graph(spark, sf_dir, name="run_kpis").run_kpis


def _brief_items(spark, sf_dir):
    return leakage.brief_items(_graph(spark, sf_dir, name="weekly_brief").leakage_report)


def _top_alert(spark, sf_dir):
    return monitoring.first_alerts(_graph(spark, sf_dir).alert_list, 1)


def _first_alerts(spark, sf_dir):
    return monitoring.first_alerts(_graph(spark, sf_dir).alert_list, 10)


def _best_scenario(spark, sf_dir):
    return scenarios.best_scenario(_graph(spark, sf_dir).scenario_plan)


def _ordered_workload(spark, sf_dir):
    return scenarios.ordered_workload(_graph(spark, sf_dir).scenario_workload)


def _payment_share(spark, sf_dir):
    return views.share_of_max(_graph(spark, sf_dir, shared=False).payment_recovery, "open_amount")


def _issue_share(spark, sf_dir):
    return views.share_of_max(views.issue_mix(_graph(spark, sf_dir).queue), "mentions")


def _queue_view(spark, sf_dir):
    return views.queue_view(_graph(spark, sf_dir).queue)


def _queue_view_today(spark, sf_dir):
    return views.queue_view(_graph(spark, sf_dir).queue, urgency="Today")


def _queue_filters(spark, sf_dir):
    return views.queue_filters(_graph(spark, sf_dir).queue)


def _issue_mix(spark, sf_dir):
    return views.issue_mix(_graph(spark, sf_dir).queue)


def _headline(spark, sf_dir):
    return _graph(spark, sf_dir, name="headline_kpis").headline_kpis


def _scenario_detail(spark, sf_dir):
    g = _graph(spark, sf_dir)
    return views.scenario_detail(g.scenario_plan, g.scenario_actions, "Balanced week")


def _segment_headline(spark, sf_dir):
    return views.segment_headline(_graph(spark, sf_dir).segment_opportunity)


def _alert_headline(spark, sf_dir):
    return views.alert_headline(_graph(spark, sf_dir, name="alert_headline").monitoring_summary)


def _leak_share(spark, sf_dir):
    return views.share_of_max(_graph(spark, sf_dir, name="leak_share").leakage_report, "revenue_at_risk")


def _top_skus(spark, sf_dir):
    return views.top_skus(_graph(spark, sf_dir, shared=False).sku_risk)


def _top_issue_segments(spark, sf_dir):
    return views.top_issue_segments(_graph(spark, sf_dir).issue_matrix)


PAST_DAYS = 90  # the past run day of the queries below, before the last one


def _past(name: str, qname: str = "") -> Query:
    """A query as of a past run day: later orders count nowhere."""

    def run(spark, sf_dir):
        return getattr(_graph(spark, sf_dir, name=qname, dates=Dates(days_back=PAST_DAYS)), name)

    return run


def _folder(spark: SparkSession, kind: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/reclaim-{kind}/{uuid.uuid4().hex}"


def _leakage_day_change(spark, sf_dir):
    """The leakage report of two run days, written as day partitions of one CSV
    report, read back by its stored schema and compared."""
    configure(spark)
    out, days = _folder(spark, "reports"), []
    for back in (PAST_DAYS, 0):
        g = _graph(spark, sf_dir, name="leakage_report", dates=Dates(days_back=back))
        days.append(g.inputs.wh.as_of)
        io.put_report(g.leakage_report, out, "leakage_report", "csv", days[-1])
    before, after = (io.get_report(spark, out, "leakage_report", "csv", day) for day in days)
    return history.day_changes(before, after, ["leak_area"], ["affected_count", "revenue_at_risk"])


def _as_csv(spark: SparkSession, sf_dir: str, tables) -> str:
    """Input tables of the warehouse written as CSV extracts."""
    inputs, folder = _graph(spark, sf_dir).inputs, _folder(spark, "extracts")
    for table in tables:
        cast = [F.col(f.name).cast(f.dataType) for f in schemas.INPUTS[table].fields]
        io.write_table(inputs[table].select(*cast), f"{folder}/{table}.csv", "csv")
    return folder


def _csv_scan(spark, sf_dir):
    """Lines read and set apart of the six inputs as CSV extracts."""
    return quality.quarantine_gate(io.read_inputs_checked(spark, _as_csv(spark, sf_dir, ALL_INPUTS)))


def _csv_channel_summary(spark, sf_dir):
    folder = _as_csv(spark, sf_dir, ["campaigns"])
    return summaries.channel_summary(io.read_csv_checked(spark, f"{folder}/campaigns.csv", "campaigns").rows)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # sources (warehouse -> six input tables)
        "input_customers": _input("customers"),
        "input_monthly_revenue": _input("monthly_revenue"),
        "input_campaigns": _input("campaigns"),
        "input_payment_events": _input("payment_events"),
        "input_fulfillment_events": _input("fulfillment_events"),
        "input_sku_inventory": _input("sku_inventory"),
        # A
        "quality_gates": _attr("quality_gates"),
        "quality_scorecard": _attr("quality_scorecard"),
        # B
        "churn_score_fixed": _attr("scored"),
        "f1_threshold": _f1,
        "classification_metrics": _metrics,
        "roc_auc": _auc,
        "top_risk_customers": _top_risk,
        "roc_auc_histogram": _auc_histogram,
        "feature_table": _features,
        "model_stationarity": _stationarity,
        "churn_train_score": _train_score,
        "model_drivers": _drivers,
        # C
        "brand_summary": _attr("brand_summary"),
        "channel_summary": _attr("channel_summary"),
        "revenue_forecast": _attr("revenue_forecast"),
        "run_kpis": _run_kpis,
        # D
        "margin_at_risk": _attr("enriched"),
        "open_failed_payments": _attr("open_failed", "open_failed_payments"),
        "late_orders": _attr("late_orders", "late_orders"),
        "discount_leak": _attr("discount_leak"),
        "channel_quality": _attr("channel_quality"),
        "weak_campaigns": _attr("weak_campaigns"),
        "sku_risk": _attr("sku_risk"),
        "support_escalation": _attr("support_leak"),
        "leakage_report": _attr("leakage_report", "leakage_report"),
        "payment_recovery": _attr("payment_recovery"),
        "weekly_brief": _attr("weekly_brief", "weekly_brief"),
        "weekly_brief_items": _brief_items,
        # E
        "action_items": _attr("action_items", "action_items"),
        "action_queue": _attr("queue"),
        "action_queue_full": _attr("queue", queue_limit=None),
        # F
        "issue_allocation": _attr("issue_allocation"),
        "playbook_roi": _attr("playbook_roi"),
        "playbook_roi_full": _attr("playbook_roi", queue_limit=None),
        "experiment_backlog": _attr("experiment_backlog"),
        "owner_workload": _attr("owner_workload"),
        # G
        "base_segments": _attr("base_segments"),
        "queue_by_segment": _attr("queue_by_segment"),
        "queue_by_segment_full": _attr("queue_by_segment", queue_limit=None),
        "dominant_issue": _attr("dominant_issue"),
        "segment_opportunity": _attr("segment_opportunity"),
        "segment_opportunity_full": _attr("segment_opportunity", queue_limit=None),
        "issue_matrix": _attr("issue_matrix"),
        "issue_matrix_full": _attr("issue_matrix", queue_limit=None),
        # H
        "metric_changes": _attr("metric_changes", "metric_changes"),
        "revenue_alerts": _attr("revenue_alerts", "revenue_alerts"),
        "churn_alerts": _attr("churn_alerts", "churn_alerts"),
        "campaign_alerts": _attr("campaign_alerts"),
        "payment_alerts": _attr("payment_alerts"),
        "fulfillment_alerts": _attr("fulfillment_alerts"),
        "inventory_alerts": _attr("inventory_alerts"),
        "alert_list": _attr("alert_list"),
        "monitoring_summary": _attr("monitoring_summary", "monitoring_summary"),
        "top_alert": _top_alert,
        "first_alerts": _first_alerts,
        # J
        "scored_actions": _attr("scored_actions"),
        "scenario_actions": _attr("scenario_actions"),
        "scenario_plan": _attr("scenario_plan"),
        "scenario_plan_full": _attr("scenario_plan", queue_limit=None),
        "best_scenario": _best_scenario,
        "scenario_workload": _attr("scenario_workload"),
        "scenario_workload_ordered": _ordered_workload,
        "scenario_summary": _attr("scenario_summary"),
        # K
        "queue_view": _queue_view,
        "queue_view_today": _queue_view_today,
        "queue_filters": _queue_filters,
        "issue_mix": _issue_mix,
        "headline_kpis": _headline,
        "scenario_detail": _scenario_detail,
        "segment_headline": _segment_headline,
        "alert_headline": _alert_headline,
        "leak_share": _leak_share,
        "payment_share": _payment_share,
        "issue_share": _issue_share,
        "top_skus": _top_skus,
        "top_issue_segments": _top_issue_segments,
        # run days, CSV extracts, report partitions
        "payment_recovery_past": _past("payment_recovery"),
        "customers_past": _past("customers"),
        "leakage_report_past": _past("leakage_report", "leakage_report"),
        "leakage_day_change": _leakage_day_change,
        "csv_scan": _csv_scan,
        "csv_channel_summary": _csv_channel_summary,
    }
    return q


# Queries without an SQL twin (model training): checked on rows only.
ROWS_ONLY = {"churn_train_score", "model_drivers"}
