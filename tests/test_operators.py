import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reclaim.operators import monitoring, playbooks, quality, scenarios, segments, summaries

QUEUE = "customer_id long, brand string, issue_type string, expected_value double, recommended_action string, reason string"


def test_decision_labels_at_thresholds(spark):
    df = spark.createDataFrame(
        [(1000.0, 3.0), (999.99, 3.0), (10.0, 1.5), (10.0, 1.49), (0.0, 9.0), (5.0, None)], "net double, roi double"
    )
    got = [r[0] for r in df.select(playbooks.decision_label(F.col("net"), F.col("roi"))).collect()]
    assert got == ["Scale this week", "Run controlled test", "Run controlled test", "Monitor economics",
                   "Do not scale yet", "Monitor economics"]


def test_playbooks_and_experiment_sizing(spark):
    q = spark.createDataFrame(
        [(1, "A", "failed_payment + late_fulfillment", 100.0, "x", "r"),
         (2, "B", "failed_payment", 50.0, "x", "r"),
         (3, "A", "mystery_issue", 70.0, "x", "r")], QUEUE)
    pb = playbooks.playbook_roi(q)
    rows = {r["issue_type"]: r.asDict() for r in pb.collect()}
    assert set(rows) == {"failed_payment", "late_fulfillment"}  # unknown issue dropped
    fp = rows["failed_payment"]
    assert fp["eligible_customers"] == 2 and fp["gross_value"] == 100.0 and fp["brands"] == "A, B"
    assert fp["total_cost"] == 2.5 and fp["expected_saved_value"] == 42.0 and fp["net_impact"] == 39.5
    exp = {r["playbook"]: r.asDict() for r in playbooks.experiment_backlog(pb).collect()}
    arm = exp["Smart dunning and payment-link recovery"]
    assert (arm["control_count"], arm["treatment_count"], arm["duration_days"]) == (5, 5, 14)
    assert arm["minimum_detectable_lift"] == 0.147


def test_control_arm_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, "failed_payment", "p", "o", 42, 0.24, "0-7 days", "m")],
                               "rank int, issue_type string, playbook string, owner string, eligible_customers long, "
                               "expected_save_rate double, speed_to_value string, primary_metric string")
    r = playbooks.experiment_backlog(df).first()
    assert (r["control_count"], r["treatment_count"], r["minimum_detectable_lift"]) == (10, 32, 0.084)


def test_scenario_capacity_and_empty_scenarios(spark):
    rows = [(i, "A", "failed_payment", 100.0 - i, "x", "r") for i in range(40)]
    rows += [(100, "A", "support_escalation", 10.0, "x", "r")]  # net = 2 - 14 < 0
    sa = scenarios.scenario_actions(scenarios.scored_actions(spark.createDataFrame(rows, QUEUE)))
    counts = {r[0]: r[1] for r in sa.groupBy("scenario").count().collect()}
    assert counts == {"Lean sprint": 6, "Balanced week": 12, "Full recovery push": 30}
    lean = [r["customer_id"] for r in sa.where("scenario = 'Lean sprint'").orderBy("customer_id").collect()]
    assert lean == [0, 1, 2, 3, 4, 5]
    plan = {r["scenario"]: r.asDict() for r in scenarios.scenario_plan(sa).collect()}
    assert plan["Lean sprint"]["top_owner"] == "Billing Ops"
    nothing = scenarios.scenario_plan(sa.limit(0)).collect()
    assert len(nothing) == 3 and all(r["selected_actions"] == 0 and r["top_owner"] == "None" for r in nothing)


def _changes(spark, pcts, deltas):
    rows = [(f"b{i}", "2025-03-01", 1000.0, 900.0, p, 10, 10.0, 0.0, 0.05, 0.05 - d, d)
            for i, (p, d) in enumerate(zip(pcts, deltas))]
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in [
        ("brand", "string"), ("latest_month", "string"), ("current_revenue", "double"),
        ("baseline_revenue", "double"), ("revenue_change_pct", "double"), ("current_active_customers", "int"),
        ("baseline_active_customers", "double"), ("active_customer_change_pct", "double"),
        ("current_churn_rate", "double"), ("baseline_churn_rate", "double"), ("churn_rate_delta", "double")]))


def test_revenue_and_churn_alert_thresholds(spark):
    ch = _changes(spark, [-0.05, -0.0499, -0.10, -0.0999], [0.015, 0.0149, 0.03, 0.0299])
    rev = {r["entity"]: r["severity"] for r in monitoring.revenue_alerts(ch).collect()}
    assert rev == {"b0": "Warning", "b2": "Critical", "b3": "Warning"}
    churn = {r["entity"]: r["severity"] for r in monitoring.churn_alerts(ch).collect()}
    assert churn == {"b0": "Warning", "b2": "Critical", "b3": "Warning"}


def test_payment_alert_on_amount_only(spark):
    cust = spark.createDataFrame([(i, "A") for i in range(100)] + [(999, "B")], "customer_id long, brand string")
    pay = spark.createDataFrame(
        [(i, i, 1300.0 if i == 0 else 10.0, "failed" if i == 0 else "paid") for i in range(100)]
        + [(5000, 12345, 50.0, "failed")],  # unknown customer: no brand, dropped
        "invoice_id long, customer_id long, invoice_amount double, payment_status string")
    got = monitoring.payment_alerts(cust, pay).collect()
    assert len(got) == 1 and got[0]["entity"] == "A" and got[0]["severity"] == "Warning"
    assert got[0]["impact_value"] == 1300.0 and got[0]["current_value"] == 0.01


def test_forecast_line_and_single_point(spark):
    rows = [(dt.date(2025, m, 1), "lin", 100.0 + 10 * m, ) for m in range(1, 7)] + [(dt.date(2025, 1, 1), "one", 5.0)]
    monthly = spark.createDataFrame(rows, "month date, brand string, subscription_revenue double")
    fc = {(r["brand"], r["month"]): r for r in summaries.revenue_forecast(monthly).collect()}
    first = fc[("lin", dt.date(2025, 7, 1))]
    assert (first["forecast_revenue"], first["lower_bound"], first["upper_bound"]) == (170.0, 170.0, 170.0)
    assert fc[("lin", dt.date(2025, 12, 1))]["forecast_revenue"] == 220.0
    assert fc[("one", dt.date(2025, 2, 1))]["forecast_revenue"] is None


def test_priority_with_zero_maxima_is_zero(spark):
    base = spark.createDataFrame([("A", "email", "monthly", 10, 0.0)],
                                 "brand string, acquisition_channel string, plan string, customers long, avg_risk_score double")
    base = base.withColumn("monthly_revenue", F.lit(1.0)).withColumn("segment_name", segments.segment_name())
    ctx = spark.createDataFrame([(1, "failed_payment", 0.0, "A", "email", "monthly", 0.0, "low")],
                                "customer_id long, issue_type string, expected_value double, brand string, "
                                "acquisition_channel string, plan string, churn_risk_score double, risk_segment string")
    r = segments.segment_opportunity(base, ctx).first()
    assert r["priority_score"] == 20.0 * 0.1 / 0.1  # only the density term is non-zero
    assert r["owner"] == "Billing Ops"


def test_global_rank_matches_row_number(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), int(rng.integers(0, 3)), float(np.round(rng.uniform(0, 50), 1))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, sev int, impact double").repartition(7)
    order = [F.col("sev").asc(), F.col("impact").desc(), F.col("id").asc()]
    got = {r["id"]: r["rank"] for r in monitoring.global_rank(df, order).collect()}
    ref = {r["id"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == ref


def test_quality_gates_detect_each_failure(spark):
    from reclaim.sources.schemas import CUSTOMERS

    good = (1, "A", "R", "email", "monthly", 3, 1, 10.0, 0.1, 0, 0, 0.5, 30.0, 0)
    bad_rows = [good, good[:7] + (-1.0,) + good[8:], good[:8] + (1.5,) + good[9:], (2,) + good[1:13] + (None,)]
    df = spark.createDataFrame([tuple(str(v) if i == 0 and v is not None else v for i, v in enumerate(r))
                                for r in bad_rows], CUSTOMERS)
    g = {r["check"]: r["failures"] for r in quality.quality_gates(df).collect()}
    assert g == {"schema_check_passed": 0, "missing_value_check_passed": 1,
                 "unique_customer_check_passed": 2, "business_rule_check_passed": 3}
    with pytest.raises(ValueError):
        quality.validate_customers(df)
    with pytest.raises(ValueError):
        quality.validate_customers(df.drop("plan"))


def test_campaign_without_customers_is_not_weak(spark):
    from reclaim.operators import leakage

    camps = spark.createDataFrame([("A", "email", 100.0, 1, 10.0), ("A", "display", 100.0, 1, 10.0),
                                   ("A", "organic", 0.0, 0, 50.0)],
                                  "brand string, acquisition_channel string, spend double, conversions int, "
                                  "attributed_revenue double")
    quality = spark.createDataFrame([("A", "email", 3, 0.5, 20.0)],
                                    "brand string, acquisition_channel string, acquired_customers long, "
                                    "avg_churn_risk double, avg_monthly_revenue double")
    weak = leakage.weak_campaigns(camps, quality).collect()
    # display has no customers and organic no spend: neither has a defined budget at risk
    assert [r["acquisition_channel"] for r in weak] == ["email"]
    assert abs(weak[0]["budget_at_risk"] - (100 * 1.9 + 100 * 0.28)) < 1e-9


def test_brand_without_inventory_gets_default_margin(spark):
    from reclaim.operators import leakage

    scored = spark.createDataFrame([(1, "A", 100.0, 0.5), (2, "Z", 100.0, 0.5)],
                                   "customer_id long, brand string, monthly_revenue double, churn_risk_score double")
    skus = spark.createDataFrame([("s1", "A", 0.30), ("s2", "A", 0.40)],
                                 "sku string, brand string, gross_margin_rate double")
    got = {r["brand"]: r for r in leakage.margin_at_risk(scored, skus).collect()}
    assert abs(got["A"]["gross_margin_rate"] - 0.35) < 1e-12
    assert got["Z"]["gross_margin_rate"] == 0.48
    assert abs(got["Z"]["six_month_margin_at_risk"] - 100 * 6 * 0.48 * 0.5) < 1e-9


def test_metric_changes_missing_latest_and_missing_baseline(spark):
    rows = [(dt.date(2025, m, 1), "full", 10, 100.0 + m, 0.05) for m in range(1, 7)]
    rows += [(dt.date(2025, m, 1), "stale", 10, 50.0, 0.05) for m in range(1, 5)]  # no latest month
    rows += [(dt.date(2025, 6, 1), "new", 10, 70.0, 0.05)]  # latest month only: no baseline
    monthly = spark.createDataFrame(rows, "month date, brand string, active_customers int, "
                                          "subscription_revenue double, monthly_churn_rate double")
    ch = {r["brand"]: r for r in monitoring.metric_changes(monthly).collect()}
    assert set(ch) == {"full", "new"}
    assert ch["full"]["baseline_revenue"] == 104.0 and ch["full"]["latest_month"] == "2025-06-01"
    assert ch["new"]["baseline_revenue"] is None and ch["new"]["revenue_change_pct"] is None
    assert monitoring.revenue_alerts(monitoring.metric_changes(monthly)).count() == 0


GATE_ROWS = "customer_id long, monthly_revenue double, discount_rate double, churned int"


def test_missing_rule_column_is_reported_not_raised(spark):
    df = spark.createDataFrame([(1, 0.2, 0), (2, 1.2, 1)], "customer_id long, discount_rate double, churned int")
    got = {r["check"]: r["failures"] for r in quality.quality_gates(df, ["customer_id", "monthly_revenue", "discount_rate", "churned"]).collect()}
    assert got["schema_check_passed"] == 1 and got["business_rule_check_passed"] == 1
    with pytest.raises(ValueError, match="monthly_revenue"):
        quality.validate_customers(df)


def test_null_id_is_no_duplicate(spark):
    df = spark.createDataFrame([(1, 5.0, 0.1, 0), (None, 5.0, 0.1, 1)], GATE_ROWS)
    got = {r["check"]: r["failures"] for r in quality.quality_gates(df, GATE_ROWS.replace(" ", ",").split(",")[:1]).collect()}
    assert got["unique_customer_check_passed"] == 0
    two = df.union(df)
    got = {r["check"]: r["failures"] for r in quality.quality_gates(two, ["customer_id"]).collect()}
    assert got["unique_customer_check_passed"] == 2


def test_money_totals_hold_large_values(spark):
    from reclaim.functions.exprs import exact_avg, exact_sum

    df = spark.createDataFrame([(1e13,), (2.5,), (3e18,)], "x double")
    r = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert r["s"] == 3e18 + 1e13 + 2.5 and abs(r["a"] - r["s"] / 3) < 1e3


def test_brand_summary_is_ordered_by_the_unrounded_mean(spark):
    rows = [(1, "A", 1.0, 0, 0.50001, 0), (2, "B", 1.0, 0, 0.50002, 0), (3, "C", 1.0, 0, 0.1, 0)]
    df = spark.createDataFrame(rows, "customer_id long, brand string, monthly_revenue double, churned int, churn_risk_score double, support_tickets_90d int")
    got = summaries.brand_summary(df).collect()
    assert [r["brand"] for r in got] == ["B", "A", "C"] and got[0]["avg_risk_score"] == got[1]["avg_risk_score"]


def test_forecast_of_an_exact_line(spark):
    rows = [(dt.date(2024, m, 1), "A", 10, 100.0 + 5.0 * m, 0.01) for m in range(1, 7)]
    df = spark.createDataFrame(rows, "month date, brand string, active_customers int, subscription_revenue double, monthly_churn_rate double")
    got = {r["month"]: r for r in summaries.revenue_forecast(df).collect()}
    assert got[dt.date(2024, 7, 1)]["forecast_revenue"] == 135.0 and got[dt.date(2024, 12, 1)]["forecast_revenue"] == 160.0
    assert all(r["lower_bound"] == r["forecast_revenue"] == r["upper_bound"] for r in got.values())


def test_channel_summary_by_hand(spark):
    df = spark.createDataFrame([("A", "email", 100.0, 8, 250.0), ("A", "display", 0.0, 0, 10.0)],
                               "brand string, acquisition_channel string, spend double, conversions int, attributed_revenue double")
    got = {r["acquisition_channel"]: r for r in summaries.channel_summary(df).collect()}
    assert got["email"]["roi"] == 1.5 and got["email"]["cost_per_conversion"] == 12.5
    assert got["display"]["roi"] is None and got["display"]["cost_per_conversion"] is None
