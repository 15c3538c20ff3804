"""Batch run: every report of the engine from one set of inputs.

The six inputs, the scored customers and the action queue each feed many
reports, so they are materialized once: written as Parquet tables under
the session's checkpoint folder (``spark.checkpoint.dir``, a shared folder
on a cluster).  The lineage is cut and a lost executor costs a re-read,
not a recompute of the warehouse adapters.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import churn, history, leakage, monitoring, quality, scenarios, summaries
from ..session import configure, delete_tables, materialize, materialize_by_key
from ..sources import io
from .graph import Graph, ModelScorer, Scorer
from .registry import ALL_INPUTS

# Report name -> how to get it from the graph.
REPORTS: dict[str, Callable[[Graph], DataFrame]] = {
    "data_quality_scorecard": lambda g: g.quality_scorecard,
    "customers_scored": lambda g: g.scored,
    "customer_risk_scores": lambda g: churn.top_risk(g.scored),
    "brand_summary": lambda g: g.brand_summary,
    "channel_summary": lambda g: g.channel_summary,
    "revenue_forecast": lambda g: g.revenue_forecast,
    "revenue_leakage_report": lambda g: g.leakage_report,
    "weekly_action_brief": lambda g: leakage.brief_record(g.leakage_report),
    "sku_risk_report": lambda g: g.sku_risk,
    "payment_recovery_summary": lambda g: g.payment_recovery,
    "action_queue": lambda g: g.queue,
    "recovery_playbook_roi": lambda g: g.playbook_roi,
    "experiment_backlog": lambda g: g.experiment_backlog,
    "owner_workload": lambda g: g.owner_workload,
    "segment_opportunity_report": lambda g: g.segment_opportunity,
    "segment_issue_matrix": lambda g: g.issue_matrix,
    "weekly_metric_changes": lambda g: g.metric_changes,
    "monitoring_alerts": lambda g: g.alert_list,
    "monitoring_summary": lambda g: monitoring.summary_record(g.alert_list, g.quality_scorecard),
    "scenario_plan": lambda g: g.scenario_plan,
    "scenario_workload": lambda g: scenarios.ordered_workload(g.scenario_workload),
    "scenario_action_plan": lambda g: g.scenario_actions,
    "scenario_summary": lambda g: scenarios.summary_record(g.scenario_plan),
    "headline_kpis": lambda g: g.headline_kpis,
}

ONE_ROW = {"weekly_action_brief", "monitoring_summary", "scenario_summary", "headline_kpis", "model_metrics"}


def read_reports(spark: SparkSession, out_dir: str, fmt: str = "parquet", run_day: dt.date | None = None) -> dict[str, DataFrame]:
    """Every report of a finished run (of one day), read back from ``out_dir``
    with the types that were written."""
    return io.read_outputs(spark, out_dir, list(REPORTS) + ["model_metrics"], ONE_ROW, fmt, run_day)


# Reports compared across days: their keys and values.
COMPARED = {
    "revenue_leakage_report": (["leak_area"], ["affected_count", "revenue_at_risk"]),
    "brand_summary": (["brand"], ["customers", "monthly_revenue", "avg_risk_score"]),
    "payment_recovery_summary": (["decline_reason"], ["failed_invoices", "open_failed", "open_amount"]),
    "action_queue": (["customer_id", "brand"], ["expected_value"]),
    "sku_risk_report": (["sku"], ["stockout_units", "margin_at_risk"]),
}


def day_changes(spark: SparkSession, out_dir: str, before: dt.date, after: dt.date, fmt: str = "parquet") -> dict[str, DataFrame]:
    """What changed in the compared reports between two run days."""
    read = lambda name, day: io.get_report(spark, out_dir, name, fmt, day)
    return {name: history.day_changes(read(name, before), read(name, after), *how) for name, how in COMPARED.items()}


def run_extracts(spark: SparkSession, directory: str, out_dir: str, most_malformed: float = quality.MOST_MALFORMED, **kw) -> dict[str, float]:
    """``run`` over six CSV extracts whose malformed lines are set apart: they
    are written as the report ``quarantined_lines``, and end the run only where
    an input has more than ``most_malformed`` of them."""
    configure(spark)
    made: list[str] = []
    try:
        inputs = io.read_inputs_checked(spark, directory, lambda df, name: materialize(df, name, made))
        io.put_report(io.quarantined(inputs), out_dir, "quarantined_lines", "parquet", kw.get("run_day"))
        quality.check_quarantine(inputs, most_malformed)
        return run(spark, {t: c.rows for t, c in inputs.items()}, out_dir=out_dir, **kw)
    finally:
        delete_tables(spark, made)


def run(spark: SparkSession, inputs: dict[str, DataFrame], out_dir: str | None = None,
        scorer: Scorer | None = None, queue_limit: int | None = 75, validate: bool = True,
        reports: list[str] | None = None, fmt: str = "parquet", run_day: dt.date | None = None) -> dict[str, float]:
    """Compute (and write, when ``out_dir`` is given, as ``fmt`` parquet, csv
    or json; one-row reports always as JSON) every report.  With ``run_day``
    reports are partitioned by day, and the run replaces that day only.  Customers are
    scored by a model trained on them, unless another ``scorer`` is given; a
    trained model adds the report ``top_model_drivers``.  Tables written for
    the run are deleted at its end.  Returns seconds per step."""
    configure(spark)
    scorer = scorer or ModelScorer()
    timings: dict[str, float] = {}
    made: list[str] = []

    def pin(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, made)

    def pin_by_key(df: DataFrame, name: str, key: str) -> DataFrame:
        return materialize_by_key(df, name, key, made)

    g = Graph(inputs, scorer=scorer, queue_limit=queue_limit, pin=pin, pin_inputs=ALL_INPUTS, pin_reports=True, pin_by_key=pin_by_key)

    def step(name: str, action: Callable[[], object]) -> None:
        t = time.time()
        action()
        timings[name] = time.time() - t

    def put(name: str, df: DataFrame) -> None:
        if not out_dir:
            df.write.format("noop").mode("overwrite").save()
        else:
            io.put_report(df, out_dir, name, fmt, run_day, name in ONE_ROW)

    try:
        if validate:
            step("validate", lambda: quality.validate_customers(g.customers))
        step("scored", lambda: g.scored)
        step("queue", lambda: g.queue)
        for name in reports or list(REPORTS):
            step(name, lambda: put(name, REPORTS[name](g)))
        if isinstance(scorer, ModelScorer) and not reports:
            step("top_model_drivers", lambda: put("top_model_drivers", churn.model_drivers(g.customers, scorer.model)))
        step("run_kpis", lambda: put("model_metrics", summaries.kpi_record(g.run_kpis)))
        timings["_kpis"] = json.dumps(g.run_kpis.first().asDict(), default=str)  # type: ignore[assignment]
    finally:
        delete_tables(spark, made)
    return timings
