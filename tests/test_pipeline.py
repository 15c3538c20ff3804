"""End to end: the six inputs as CSV extracts (string ids, explicit
schemas) -> batch run with a trained model -> reports written, read back
and served by the read-side views."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from reclaim.operators import views
from reclaim.plans import pipeline
from reclaim.sources import io, schemas, tpch

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="warehouse fixture not available")


@pytest.fixture(scope="module")
def extracts(spark):
    folder = tempfile.mkdtemp(prefix="reclaim-extracts-")
    inputs = tpch.load(spark, SF_SMALL)
    for table, schema in schemas.INPUTS.items():
        df = inputs[table].select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{table}.csv")
    return folder


def test_csv_extracts_to_reports(spark, extracts):
    inputs = io.read_inputs(spark, extracts, "csv")
    assert dict(inputs["customers"].dtypes)["customer_id"] == "string"
    out = tempfile.mkdtemp(prefix="reclaim-reports-")
    steps = pipeline.run(spark, inputs, out_dir=out)
    assert "run_kpis" in steps
    reports = pipeline.read_reports(spark, out)
    kpi = reports["model_metrics"].first()
    assert kpi["rows_processed"] == 150 and kpi["leakage_categories"] == 6
    assert 0.0 <= kpi["model"]["roc_auc"] <= 1.0 and len(kpi["model"]) == 10
    assert len(kpi["validation_checks"]) == 4
    assert reports["customers_scored"].count() == 150
    assert spark.read.parquet(f"{out}/top_model_drivers").count() == 12
    brief = reports["weekly_action_brief"].first()
    assert [a["rank"] for a in brief["leakage_items"]] == [1, 2, 3] and brief["leakage_items"][0]["leak_area"] == brief["top_leak_area"]
    best = reports["scenario_summary"].first()["best_scenario"]
    assert best["net_impact"] == reports["scenario_plan"].agg(F.max("net_impact")).first()[0]
    ranks = [r["rank"] for r in reports["monitoring_alerts"].collect()]
    assert ranks == sorted(ranks)
    assert reports["monitoring_summary"].first()["top_alert"]["rank"] == 1
    queue = reports["action_queue"]
    assert queue.count() == kpi["action_queue_items"] <= 75
    # read side from the written reports
    head = views.headline_kpis(reports["payment_recovery_summary"], reports["sku_risk_report"],
                               reports["recovery_playbook_roi"], queue).first()
    assert head["queue_items"] == kpi["action_queue_items"]
    assert abs(head["net_impact"] - kpi["playbook_net_impact"]) < 0.02
    seen = views.queue_view(queue, owner="Billing Ops").collect()
    assert all(r["owner"] == "Billing Ops" for r in seen)
    assert reports["monitoring_alerts"].count() == reports["monitoring_summary"].first()["open_alerts"]


def test_full_queue_downstream_invariants(spark):
    from reclaim.plans.graph import Graph

    g = Graph.from_warehouse(spark, SF_SMALL, queue_limit=None)
    q = g.queue.toPandas()
    items = g.action_items.toPandas().dropna(subset=["brand"])
    assert abs(q["expected_value"].sum() - items["expected_value"].sum()) < 0.01 * len(q)
    alloc = g.issue_allocation.toPandas()
    assert abs(alloc["allocated_value"].sum() - q["expected_value"].sum()) < 1e-6 * max(1, len(q))
    sel = g.scenario_actions.toPandas()
    caps = {"Lean sprint": 6, "Balanced week": 12, "Full recovery push": 30}
    per = sel.groupby(["scenario", "owner"]).size()
    for (scenario, owner), n in per.items():
        from reclaim.functions.dims import SCENARIO_CAPACITY

        assert n <= SCENARIO_CAPACITY[scenario][owner]
    plan = g.scenario_plan.toPandas().set_index("scenario")
    assert plan.loc["Lean sprint", "selected_actions"] <= plan.loc["Balanced week", "selected_actions"] \
        <= plan.loc["Full recovery push", "selected_actions"]
    assert (abs(plan["net_impact"] - (plan["expected_saved_value"] - plan["execution_cost"])) <= 0.011).all()


def test_csv_reports_and_fixed_scorer(spark):
    from reclaim.plans.graph import fixed_scorer

    out = tempfile.mkdtemp(prefix="reclaim-csv-")
    pipeline.run(spark, tpch.load(spark, SF_SMALL), out_dir=out, scorer=fixed_scorer, fmt="csv", reports=["channel_summary", "scenario_plan"])
    plan = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/scenario_plan")
    assert plan.count() == 3 and "net_impact" in plan.columns


def test_tables_of_a_run_are_deleted(spark, monkeypatch):
    made = []
    from reclaim.plans import pipeline as p

    real = p.delete_tables
    monkeypatch.setattr(p, "delete_tables", lambda s, paths: (made.extend(paths), real(s, paths)))
    from reclaim.plans.graph import fixed_scorer

    p.run(spark, tpch.load(spark, SF_SMALL), scorer=fixed_scorer, reports=["brand_summary"])
    assert made and not any(os.path.exists(m.removeprefix("file:")) for m in made)


def test_run_day_and_windows_are_parameters(spark):
    import datetime as dt

    wh = tpch.Warehouse(spark, SF_SMALL)
    last = wh.table("orders").agg(F.max("o_orderdate").cast("date")).first()[0]
    assert wh.as_of == last + dt.timedelta(days=1)
    assert wh.orders_before().count() == wh.table("orders").count()  # no order is later than the run day
    early = tpch.Warehouse(spark, SF_SMALL, dates=tpch.Dates(as_of=last - dt.timedelta(days=365), ticket_days=30))
    assert early.orders_before().count() < wh.table("orders").count()
    every = tpch.customers(tpch.Warehouse(spark, SF_SMALL, customers_without_orders=True))
    assert every.count() == wh.table("customer").count()
    none = every.where("active_subscriptions = 0 AND monthly_revenue = 0").first()
    assert none is None or (none["tenure_months"], none["churned"]) == (0, 0)
