"""Replays of published outputs from the checked-in input extracts
(read as data from the reference folder; skipped when it is absent)."""

import os

import pandas as pd
import pytest

from reclaim.operators import leakage, monitoring, playbooks, scenarios, summaries
from reclaim.sources import io

from conftest import REFERENCE

RAW = f"{REFERENCE}/data/raw"
REPORTS = f"{REFERENCE}/reports"
pytestmark = pytest.mark.skipif(not os.path.isdir(RAW), reason="reference extracts not available")

QUEUE_SCHEMA = ("customer_id string, brand string, issue_type string, expected_value double, "
                "recommended_action string, reason string")


def golden(name):
    return pd.read_csv(f"{REPORTS}/{name}")


def close(a, b, tol=1e-9):
    return (pd.isna(a) and pd.isna(b)) or abs(float(a) - float(b)) <= tol


def test_channel_summary(spark):
    got = summaries.channel_summary(io.read_csv_input(spark, f"{RAW}/campaigns.csv", "campaigns")).toPandas()
    exp = golden("channel_summary.csv")
    m = exp.merge(got, on=["brand", "acquisition_channel"], suffixes=("_e", "_g"))
    assert len(m) == len(exp) == 20
    for c in ("roi", "cost_per_conversion"):
        assert all(close(a, b) for a, b in zip(m[c + "_e"], m[c + "_g"])), c


def test_revenue_forecast_and_metric_changes(spark):
    monthly = io.read_csv_input(spark, f"{RAW}/monthly_revenue.csv", "monthly_revenue")
    got = summaries.revenue_forecast(monthly).toPandas()
    got["month"] = got["month"].astype(str)
    exp = golden("revenue_forecast.csv")
    m = exp.merge(got, on=["month", "brand"], suffixes=("_e", "_g"))
    assert len(m) == len(exp) == 24
    for c in ("forecast_revenue", "lower_bound", "upper_bound"):
        assert all(close(a, b, 0.011) for a, b in zip(m[c + "_e"], m[c + "_g"])), c
    ch = monitoring.metric_changes(monthly).toPandas()
    exp = golden("weekly_metric_changes.csv")
    m = exp.merge(ch, on="brand", suffixes=("_e", "_g"))
    assert len(m) == 4
    for c in exp.columns:
        if c == "brand":
            continue
        assert all((a == b) if isinstance(a, str) else close(a, b, 1e-9) for a, b in zip(m[c + "_e"], m[c + "_g"])), c


def test_sku_risk_and_alerts(spark):
    skus = io.read_csv_input(spark, f"{RAW}/sku_inventory.csv", "sku_inventory")
    got = leakage.sku_risk(skus).toPandas()
    exp = golden("sku_risk_report.csv")
    short = exp["margin_at_risk"] > 0  # zero-margin SKUs tie; their order is arbitrary
    assert list(got["sku"][: short.sum()]) == list(exp["sku"][short])
    m = exp.merge(got, on="sku", suffixes=("_e", "_g"))
    assert len(m) == len(exp) == 12
    for c in ("stockout_units", "stockout_risk", "margin_at_risk"):
        assert all(close(a, b, 1e-6) for a, b in zip(m[c + "_e"], m[c + "_g"])), c
    alerts = pd.concat([
        monitoring.inventory_alerts(skus).toPandas(),
        monitoring.campaign_alerts(io.read_csv_input(spark, f"{RAW}/campaigns.csv", "campaigns")).toPandas(),
    ])
    exp = golden("monitoring_alerts.csv")
    exp = exp[exp["alert_type"].isin(["Stockout risk", "Campaign payback"])]
    m = exp.merge(alerts, on=["alert_type", "entity"], suffixes=("_e", "_g"))
    assert len(m) == len(exp) == len(alerts)
    assert (m["severity_e"] == m["severity_g"]).all()
    for c in ("current_value", "baseline_value", "change_pct", "impact_value"):
        assert all(close(a, b, 1e-9) for a, b in zip(m[c + "_e"], m[c + "_g"])), c


@pytest.fixture(scope="module")
def queue(spark):
    return spark.read.schema(QUEUE_SCHEMA).option("header", True).csv(f"{REPORTS}/action_queue.csv")


def test_playbooks_from_queue(spark, queue):
    pb = playbooks.playbook_roi(queue)
    got = pb.toPandas()
    exp = golden("recovery_playbook_roi.csv")
    m = exp.merge(got, on="issue_type", suffixes=("_e", "_g"))
    assert len(m) == 4
    assert list(m["rank_e"]) == list(m["rank_g"]) and list(m["decision_e"]) == list(m["decision_g"])
    assert list(m["brands_e"]) == list(m["brands_g"]) and list(m["owner_e"]) == list(m["owner_g"])
    for c in ("eligible_customers", "gross_value", "avg_customer_value", "total_cost", "expected_saved_value",
              "net_impact", "roi"):
        assert all(close(a, b, 0.011) for a, b in zip(m[c + "_e"], m[c + "_g"])), c
    ex = playbooks.experiment_backlog(pb).toPandas().sort_values("experiment_id")
    gold = golden("experiment_backlog.csv").sort_values("experiment_id")
    for c in ("experiment_id", "treatment_count", "control_count", "minimum_detectable_lift", "duration_days"):
        assert list(ex[c]) == list(gold[c]), c


def test_scenarios_from_queue(spark, queue):
    sa = scenarios.scenario_actions(scenarios.scored_actions(queue))
    plan = scenarios.scenario_plan(sa).toPandas()
    exp = golden("scenario_plan.csv")
    m = exp.merge(plan, on="scenario", suffixes=("_e", "_g"))
    assert len(m) == 3
    assert list(m["selected_actions_e"]) == list(m["selected_actions_g"])
    assert list(m["top_owner_e"]) == list(m["top_owner_g"])
    for c in ("covered_expected_value", "expected_saved_value", "execution_cost", "net_impact", "roi"):
        assert all(close(a, b, 0.011) for a, b in zip(m[c + "_e"], m[c + "_g"])), c
    wl = scenarios.scenario_workload(sa).toPandas()
    exp = golden("scenario_workload.csv")
    m = exp.merge(wl, on=["scenario", "owner", "playbook"], suffixes=("_e", "_g"))
    assert len(m) == len(exp) == len(wl)
    for c in ("selected_actions", "expected_saved_value", "execution_cost", "net_impact"):
        assert all(close(a, b, 0.011) for a, b in zip(m[c + "_e"], m[c + "_g"])), c
