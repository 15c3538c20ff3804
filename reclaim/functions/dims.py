"""Small dimension tables: playbooks, scenario capacities, leak areas,
issue labels and data-quality rules.

Each is a handful of rows fixed by configuration (never by data), so joining
them with ``broadcast`` is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Fixed values.  These numbers and labels must equal the original engine's
# for results to agree: issue types, owners, unit costs, save rates,
# speed labels, scenario names and capacities, severities, urgencies,
# thresholds.  Descriptive texts are composed from the rules.
# ---------------------------------------------------------------------------

ISSUES = ["failed_payment", "late_fulfillment", "discount_margin_leak", "support_escalation"]

# issue_type, playbook, owner, cost_per_action, expected_save_rate,
# speed_to_value, primary_metric, points the metric must gain, guardrail
_PLAYBOOK_RULES = [
    ("failed_payment", "Smart dunning and payment-link recovery", "Billing Ops", 1.25, 0.42, "0-7 days",
     "Recovered invoice rate", 8, "refund complaints <= control"),
    ("late_fulfillment", "Late-shipment rescue workflow", "Operations", 9.00, 0.24, "7-21 days",
     "Next renewal retained", 5, "margin > 0"),
    ("discount_margin_leak", "Offer ladder instead of blanket discounts", "Growth", 3.50, 0.16, "14-30 days",
     "Gross margin retained", 4, "churn <= control"),
    ("support_escalation", "Priority callback for high-value subscribers", "Customer Success", 14.00, 0.20, "7-14 days",
     "Escalation retention rate", 6, "callback SLA met"),
]

# The last two columns are texts made from the rule: what the experiment
# compares, and the condition for scaling.
PLAYBOOK_ROWS = [
    (*fields, f"{fields[6]}: treated > control ({fields[0]})", f"{fields[6]} >= control + {points} pt; {guard}")
    for *fields, points, guard in _PLAYBOOK_RULES
]

PLAYBOOK_COLUMNS = [
    "issue_type",
    "playbook",
    "owner",
    "cost_per_action",
    "expected_save_rate",
    "speed_to_value",
    "primary_metric",
    "hypothesis",
    "decision_rule",
]

# Lookup defaults for an issue without a playbook.
DEFAULT_OWNER = "Ops"
DEFAULT_PLAYBOOK = "Review recovery queue"
DEFAULT_COST = 5.0
DEFAULT_SAVE_RATE = 0.15
DEFAULT_METRIC = "segment recovery"
DEFAULT_URGENCY = "This week"

# Dashboard issue metadata: issue_type, owner, urgency, label.
ISSUE_META_ROWS = [
    ("failed_payment", "Billing Ops", "Today", "Failed payment"),
    ("late_fulfillment", "Operations", "This week", "Late fulfillment"),
    ("discount_margin_leak", "Growth", "This week", "Discount leakage"),
    ("support_escalation", "Customer Success", "Today", "Support escalation"),
]

# Capacities per scenario and owner, in the order
# Billing Ops, Operations, Customer Success, Growth.
SCENARIO_CAPACITY = {
    "Lean sprint": {"Billing Ops": 6, "Operations": 8, "Customer Success": 5, "Growth": 3},
    "Balanced week": {"Billing Ops": 12, "Operations": 18, "Customer Success": 12, "Growth": 8},
    "Full recovery push": {"Billing Ops": 30, "Operations": 45, "Customer Success": 30, "Growth": 20},
}
# Scenarios: name, display order, description (its capacities).
SCENARIO_ROWS = [
    (name, place, f"up to {sum(caps.values())} actions: " + ", ".join(f"{owner} {n}" for owner, n in caps.items()))
    for place, (name, caps) in enumerate(SCENARIO_CAPACITY.items(), 1)
]
BALANCED_SCENARIO = "Balanced week"

# Leak areas: key, leak_area, owner, urgency, rule, column that ranks the work.
_LEAK_RULES = [
    ("payment", "Failed payment recovery", "Billing Ops", "Today", "payment_status = failed", "invoice_amount"),
    ("late", "Fulfillment-driven churn", "Operations", "This week", "late_flag = 1", "six_month_margin_at_risk"),
    ("discount", "Discount margin leakage", "Growth", "This week", "discount_rate >= 0.35, churn_risk_score >= 0.30", "discount_margin_leak"),
    ("campaign", "Campaign quality leakage", "Marketing", "Next budget cycle", "roi < 1 or avg_churn_risk > 0.22", "budget_at_risk"),
    ("inventory", "SKU stockout exposure", "Inventory", "This week", "forecast_30d_units > on_hand_units", "margin_at_risk"),
    ("support", "Support escalation risk", "Customer Success", "Today", "support_tickets_90d >= 3, churn_risk_score >= 0.35", "six_month_margin_at_risk"),
]
# key, leak_area, owner, urgency, problem, recommended_action.
LEAK_AREA_ROWS = [
    (key, area, owner, urgency, f"Rule: {rule}", f"{owner}: work the rows by {value}, descending")
    for key, area, owner, urgency, rule, value in _LEAK_RULES
]

# Queue actions per issue type; a failed payment adds its decline reason.
QUEUE_ACTIONS = {
    "failed_payment": "Billing Ops: payment link, decline code ",
    "late_fulfillment": "Operations: rescue workflow",
    "discount_margin_leak": "Growth: offer ladder",
    "support_escalation": "Customer Success: callback",
}

# Risk bins on the rounded score: right-closed, lowest edge included.
RISK_BINS = [(0.25, "low"), (0.45, "watch"), (0.65, "high"), (1.0, "critical")]

# Severity order for alerts.
SEVERITY_RANK = {"Critical": 0, "Warning": 1, "Watch": 2}


def _frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema=schema)


def playbooks(spark: SparkSession) -> DataFrame:
    return _frame(
        spark,
        PLAYBOOK_ROWS,
        "issue_type string, playbook string, owner string, cost_per_action double, "
        "expected_save_rate double, speed_to_value string, primary_metric string, "
        "hypothesis string, decision_rule string",
    )


def issue_meta(spark: SparkSession) -> DataFrame:
    return _frame(spark, ISSUE_META_ROWS, "issue_type string, owner string, urgency string, issue_label string")


def scenarios(spark: SparkSession) -> DataFrame:
    return _frame(spark, SCENARIO_ROWS, "scenario string, scenario_order int, description string")


def scenario_capacity(spark: SparkSession) -> DataFrame:
    rows = [(name, owner, cap) for name, caps in SCENARIO_CAPACITY.items() for owner, cap in caps.items()]
    return _frame(spark, rows, "scenario string, owner string, capacity int")


def leak_areas(spark: SparkSession) -> DataFrame:
    return _frame(
        spark,
        LEAK_AREA_ROWS,
        "area_key string, leak_area string, owner string, urgency string, problem string, recommended_action string",
    )
