"""Independent SQL statements of every checkable query, for DuckDB.

The statements read the warehouse views ``region nation customer part
orders lineitem`` directly; each query is a chain of CTEs.  ``sql(name)``
returns ``WITH <the CTEs it needs> SELECT * FROM <name>``.

Conventions shared with the DataFrame side: doubles are written with an
exponent (``1.9e0``) so DuckDB does not switch to DECIMAL arithmetic;
table rounding is half-to-even after scaling; money totals are summed in
fixed point; integer sums are cast back to BIGINT.
"""

from __future__ import annotations

import re

from ..functions import dims
from ..operators import churn, monitoring, scenarios
from ..sources import tpch


# -- small SQL helpers --------------------------------------------------------
def R(expr: str, d: int) -> str:
    s = f"{10 ** d}e0"
    return f"(round_even(({expr}) * {s}, 0) / {s} + 0.0e0)"


def XSUM(expr: str) -> str:
    return f"coalesce(CAST(sum(CAST(({expr}) AS DECIMAL(28,6))) AS DOUBLE), 0.0e0)"


def XAVG(expr: str) -> str:
    return f"(CAST(sum(CAST(({expr}) AS DECIMAL(28,6))) AS DOUBLE) / count({expr}))"


def PSUM(expr: str) -> str:
    return f"coalesce(CAST(sum(CAST(({expr}) AS DECIMAL(38,12))) AS DOUBLE), 0.0e0)"


def PAVG(expr: str) -> str:
    return f"(CAST(sum(CAST(({expr}) AS DECIMAL(38,12))) AS DOUBLE) / count({expr}))"


def D(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def S(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def CASE_MOD(key: str, labels: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {S(v)}" for i, v in enumerate(labels))
    return f"(CASE ({key}) % {len(labels)} {whens} END)"


def VALUES(rows, columns: list[str]) -> str:
    def lit(v):
        if isinstance(v, str):
            return S(v)
        if isinstance(v, float):
            return D(v)
        return str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"


def BEFORE(days: int) -> str:
    return f"(SELECT CAST(d - {days} AS TIMESTAMP) FROM run_day)"


AS_OF = BEFORE(0)
RECENT = BEFORE(181)
TICKETS = BEFORE(90)
CHURN_BEFORE = BEFORE(365)
CAMPAIGN_START = BEFORE(92)
CENTS = "CAST(round_even(({x}) * 100e0, 0) AS BIGINT)"
TENURE = "((SELECT year(d) * 12 + month(d) FROM run_day) - (year(ot.first_order) * 12 + month(ot.first_order)))"
CHANNEL = CASE_MOD("c.c_custkey", tpch.CHANNELS)
PLAN = "(CASE WHEN c.c_custkey % 7 <= 3 THEN 'monthly' WHEN c.c_custkey % 7 <= 5 THEN 'quarterly' ELSE 'annual' END)"
SEG_KEYS = "brand, acquisition_channel, plan"
SEG_NOT_NULL = "brand IS NOT NULL AND acquisition_channel IS NOT NULL AND plan IS NOT NULL"
ITEM_ORDER = "k_missing, k_value, branch, reason, recommended_action"
ISSUES_OF = "string_split(issue_type, ' + ')"

C = tpch.SCORE_COEF
LOGIT = (
    f"({D(tpch.SCORE_INTERCEPT)} + {D(C['discount_rate'])} * discount_rate"
    f" + {D(C['support_tickets_90d'])} * support_tickets_90d"
    f" + {D(C['late_shipments_90d'])} * late_shipments_90d"
    f" + {D(C['email_engagement'])} * email_engagement"
    f" + {D(C['tenure_months'])} * (tenure_months - {tpch.TENURE_CENTER})"
    f" + {D(C['avg_days_between_orders'])} * avg_days_between_orders)"
)
PROB = f"(1.0e0 / (1.0e0 + exp(-greatest(-35.0e0, least(35.0e0, {LOGIT})))))"
HOLDOUT = "(CAST('0x' || md5(CAST(customer_id AS VARCHAR) || '|11')[1:8] AS BIGINT) % 100 >= 78)"
GRID = "[" + ", ".join(D(t) for t in churn.thresholds()) + "]"


def _risk_segment(col: str) -> str:
    (u0, l0), (u1, l1), (u2, l2), (u3, l3) = dims.RISK_BINS
    return (
        f"(CASE WHEN {col} < 0 OR {col} > {D(u3)} THEN NULL WHEN {col} <= {D(u0)} THEN {S(l0)} WHEN {col} <= {D(u1)} THEN {S(l1)} "
        f"WHEN {col} <= {D(u2)} THEN {S(l2)} WHEN {col} <= {D(u3)} THEN {S(l3)} END)"
    )


def _alert(src: str, where: str, severity: str, owner: str, alert_type: str, entity: str, metric: str,
           current: str, baseline: str, change: str, impact: str, rec: str) -> str:
    return (
        f"SELECT {severity} AS severity, {S(owner)} AS owner, {S(alert_type)} AS alert_type, "
        f"CAST({entity} AS VARCHAR) AS entity, {S(metric)} AS metric, "
        f"{R(f'CAST({current} AS DOUBLE)', 4)} AS current_value, {R(f'CAST({baseline} AS DOUBLE)', 4)} AS baseline_value, "
        f"{R(f'CAST({change} AS DOUBLE)', 4)} AS change_pct, {R(f'CAST({impact} AS DOUBLE)', 2)} AS impact_value, "
        f"{S(rec)} AS recommendation FROM {src} WHERE {where}"
    )


M = monitoring
REC = monitoring.REC

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


# -- sources ------------------------------------------------------------------
cte("run_day", "SELECT CAST(max(o_orderdate) AS DATE) + 1 AS d FROM orders")
cte("ob", f"SELECT * FROM orders WHERE o_orderdate < {AS_OF}")
cte("wl", f"SELECT * FROM lineitem WHERE l_shipdate >= {RECENT}")
cte("rl", "SELECT wl.*, o.o_custkey FROM wl JOIN ob o ON wl.l_orderkey = o.o_orderkey")
cte("ot", f"""SELECT o_custkey AS ck, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
  count(*) AS n_orders, count_if(o_orderstatus = 'O') AS n_open,
  sum({CENTS.format(x='o_totalprice')}) AS price_cents,
  count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS n_engaged
  FROM ob GROUP BY o_custkey""")
cte("wt", f"""SELECT o_custkey AS ck, count(*) AS n_lines, sum({CENTS.format(x='l_discount')}) AS discount_cents,
  count_if(l_returnflag = 'R' AND l_shipdate >= {TICKETS}) AS n_returned,
  count_if(l_returnflag = 'A' AND l_linestatus = 'F' AND l_shipdate >= {TICKETS}) AS n_late
  FROM rl GROUP BY o_custkey""")
cte("t_customers", f"""SELECT c.c_custkey AS customer_id, c.c_mktsegment AS brand, r.r_name AS region,
  {CHANNEL} AS acquisition_channel, {PLAN} AS plan,
  CAST({TENURE} AS INTEGER) AS tenure_months,
  CAST(ot.n_open AS INTEGER) AS active_subscriptions,
  CAST(ot.price_cents AS DOUBLE) / 100000e0 / greatest({TENURE}, 1) AS monthly_revenue,
  coalesce(least(0.55e0, 5.0e0 * CAST(wt.discount_cents AS DOUBLE) / (100.0e0 * wt.n_lines)), 0.0e0) AS discount_rate,
  CAST(coalesce(wt.n_returned, 0) AS INTEGER) AS support_tickets_90d,
  CAST(coalesce(wt.n_late, 0) AS INTEGER) AS late_shipments_90d,
  CAST(ot.n_engaged AS DOUBLE) / ot.n_orders AS email_engagement,
  CASE WHEN ot.n_orders = 1 THEN 30.0e0
       ELSE CAST(date_diff('day', CAST(ot.first_order AS DATE), CAST(ot.last_order AS DATE)) AS DOUBLE) / (ot.n_orders - 1)
  END AS avg_days_between_orders,
  CASE WHEN ot.last_order < {CHURN_BEFORE} THEN 1 ELSE 0 END AS churned
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN ot ON c.c_custkey = ot.ck LEFT JOIN wt ON c.c_custkey = wt.ck""")
cte("t_monthly", f"""SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, c.c_mktsegment AS brand,
  CAST(count(DISTINCT o.o_custkey) AS INTEGER) AS active_customers,
  CAST(sum({CENTS.format(x='o.o_totalprice')}) AS DOUBLE) / 100000e0 AS subscription_revenue,
  CAST(count_if(o.o_orderstatus = 'F' AND o.o_orderpriority = '5-LOW') AS DOUBLE) / count(*) AS monthly_churn_rate
  FROM ob o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY CAST(date_trunc('month', o.o_orderdate) AS DATE), c.c_mktsegment""")
cte("t_campaigns", f"""SELECT c.c_mktsegment AS brand, {CHANNEL} AS acquisition_channel,
  CAST(coalesce(sum(CASE WHEN o.o_orderstatus = 'P' THEN {CENTS.format(x='o.o_totalprice')} END), 0) AS DOUBLE) / 10000e0 AS spend,
  CAST(count(*) AS INTEGER) AS conversions,
  CAST(coalesce(sum(CASE WHEN o.o_orderstatus <> 'P' THEN {CENTS.format(x='o.o_totalprice')} END), 0) AS DOUBLE) / 10000e0 AS attributed_revenue
  FROM ob o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderdate >= {CAMPAIGN_START}
  GROUP BY c.c_mktsegment, {CHANNEL}""")
cte("last_order", """SELECT *, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'failed'
  WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'recovered' ELSE 'paid' END AS st
  FROM ob QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
cte("t_payments", f"""SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, o_totalprice / 1000e0 AS invoice_amount,
  st AS payment_status,
  CASE WHEN st <> 'paid' THEN {CASE_MOD('o_orderkey', tpch.DECLINE_REASONS)} ELSE 'none' END AS decline_reason,
  CAST(CASE WHEN st <> 'paid' THEN 1 + o_orderkey % 3 ELSE 0 END AS INTEGER) AS retry_count,
  CAST(CASE WHEN st = 'failed' THEN 1 + o_orderkey % 17 ELSE 0 END AS INTEGER) AS days_past_due
  FROM last_order""")
cte("t_fulfillment", """SELECT order_id, customer_id, brand, sku, CAST(promised AS INTEGER) AS promised_days,
  CAST(actual AS INTEGER) AS actual_days, CAST(actual > promised + 1 AS INTEGER) AS late_flag,
  CASE WHEN actual > promised + 1 THEN 'late' ELSE 'on_time' END AS fulfillment_status
  FROM (SELECT l_orderkey AS order_id, o_custkey AS customer_id, c.c_mktsegment AS brand, l_partkey AS sku,
          2 + l_linenumber % 4 AS promised,
          greatest(1, 2 + l_linenumber % 4 + CAST(trunc(l_quantity % 5) AS INTEGER) - 1) AS actual
        FROM rl JOIN customer c ON rl.o_custkey = c.c_custkey)""")
cte("demand", f"SELECT l_partkey, sum(l_quantity) AS qty FROM wl WHERE l_shipdate < {AS_OF} GROUP BY l_partkey")
cte("t_skus", f"""SELECT p_partkey AS sku, {CASE_MOD('p_partkey', tpch.SEGMENTS)} AS brand, p_type AS category,
  CAST(p_size AS INTEGER) AS on_hand_units,
  CAST(coalesce(floor(d.qty / 6e0), 0) AS INTEGER) AS forecast_30d_units,
  p_retailprice / 10e0 AS unit_price,
  0.34e0 + CAST(p_partkey % 35 AS DOUBLE) / 100e0 AS gross_margin_rate,
  CAST(8 + p_partkey % 23 AS INTEGER) AS supplier_lead_time_days
  FROM part LEFT JOIN demand d ON p_partkey = d.l_partkey""")

# -- A ------------------------------------------------------------------------
_REQ = [
    "customer_id", "brand", "region", "acquisition_channel", "plan", "tenure_months", "active_subscriptions",
    "monthly_revenue", "discount_rate", "support_tickets_90d", "late_shipments_90d", "email_engagement",
    "avg_days_between_orders", "churned",
]
_NULLS = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in _REQ)
cte("gate_stats", f"""SELECT CAST(coalesce(sum({_NULLS}), 0) AS BIGINT) AS nulls,
  count(*) - count(DISTINCT customer_id) - coalesce(max(CAST(customer_id IS NULL AS INTEGER)), 0) AS dups,
  count_if(NOT coalesce(monthly_revenue > 0 AND discount_rate BETWEEN 0 AND 1 AND churned IN (0, 1), false)) AS rule_failures
  FROM t_customers""")
cte("quality_gates", """SELECT 'schema_check_passed' AS "check", CAST(0 AS BIGINT) AS failures, true AS passed
  UNION ALL SELECT 'missing_value_check_passed', nulls, nulls = 0 FROM gate_stats
  UNION ALL SELECT 'unique_customer_check_passed', dups, dups = 0 FROM gate_stats
  UNION ALL SELECT 'business_rule_check_passed', rule_failures, rule_failures = 0 FROM gate_stats""")
_ALL_NULLS = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in _REQ + ["churn_risk_score", "risk_segment"])
cte("sc_stats", f"""SELECT * FROM
  (SELECT count(*) AS customer_rows, count(*) - count(DISTINCT customer_id) - coalesce(max(CAST(customer_id IS NULL AS INTEGER)), 0) AS customer_dups,
          CAST(coalesce(sum({_ALL_NULLS}), 0) AS BIGINT) AS customer_nulls FROM scored),
  (SELECT count(DISTINCT month) AS months FROM t_monthly),
  (SELECT count(*) AS campaign_rows FROM t_campaigns),
  (SELECT count(*) AS payment_rows FROM t_payments),
  (SELECT count(*) AS fulfillment_rows FROM t_fulfillment),
  (SELECT count(*) AS sku_rows FROM t_skus)""")


def _qrow(check, value, passed, owner, expectation):
    return (f"SELECT {S(check)} AS \"check\", CAST({value} AS BIGINT) AS value, "
            f"CASE WHEN {passed} THEN 'Healthy' ELSE 'Needs review' END AS status, {S(owner)} AS owner, "
            f"{S(expectation)} AS expectation FROM sc_stats")


cte("quality_scorecard", " UNION ALL ".join([
    _qrow("Customer rows", "customer_rows", "customer_rows >= 2500", "Data Engineering", "value >= 2500"),
    _qrow("Customer duplicates", "customer_dups", "customer_dups = 0", "Data Engineering", "value = 0"),
    _qrow("Customer missing values", "customer_nulls", "customer_nulls = 0", "Data Engineering", "value = 0"),
    _qrow("Monthly revenue coverage", "months", "months >= 12", "Analytics", "value >= 12"),
    _qrow("Campaign ROI inputs", "campaign_rows", "true", "Marketing Ops", "columns: spend, attributed_revenue, conversions"),
    _qrow("Payment events coverage", "payment_rows", "payment_rows = customer_rows", "Billing Ops", "value = customer rows"),
    _qrow("Fulfillment sample coverage", "fulfillment_rows", "fulfillment_rows >= 1500", "Operations", "value >= 1500"),
    _qrow("Inventory SKU coverage", "sku_rows", "sku_rows >= 12", "Inventory", "value >= 12"),
]))

# -- B ------------------------------------------------------------------------
cte("scored", f"""SELECT *, {_risk_segment('churn_risk_score')} AS risk_segment FROM
  (SELECT *, {R(PROB, 4)} AS churn_risk_score FROM t_customers)""")
cte("hold", f"SELECT customer_id, churned, {PROB} AS p, {LOGIT} AS logit, {R(PROB, 4)} AS churn_risk_score FROM t_customers WHERE {HOLDOUT}")
cte("thr_hist", f"""SELECT len(list_filter({GRID}, lambda t: p >= t)) AS bucket,
  count_if(churned = 1) AS pos, count_if(churned = 0) AS neg FROM hold GROUP BY 1""")
cte("thr_grid", "SELECT i - 1 AS i, t FROM (SELECT unnest(range(1, len(g) + 1)) AS i, unnest(g) AS t FROM (SELECT "
    + GRID + " AS g))")
cte("sweep", """SELECT i, t AS threshold, tp, fp, fn, tn,
  CAST(tp AS DOUBLE) / greatest(tp + fp, 1) AS precision, CAST(tp AS DOUBLE) / greatest(tp + fn, 1) AS recall
  FROM (SELECT g.i, g.t,
    CAST(coalesce(sum(CASE WHEN h.bucket > g.i THEN h.pos ELSE 0 END), 0) AS BIGINT) AS tp,
    CAST(coalesce(sum(CASE WHEN h.bucket > g.i THEN h.neg ELSE 0 END), 0) AS BIGINT) AS fp,
    CAST(coalesce(sum(CASE WHEN h.bucket > g.i THEN 0 ELSE h.pos END), 0) AS BIGINT) AS fn,
    CAST(coalesce(sum(CASE WHEN h.bucket > g.i THEN 0 ELSE h.neg END), 0) AS BIGINT) AS tn
    FROM thr_grid g, thr_hist h GROUP BY g.i, g.t)""")
cte("best_sweep", """SELECT *, 2.0e0 * precision * recall / greatest(precision + recall, 1e-12) AS f1 FROM sweep
  ORDER BY f1 DESC, i LIMIT 1""")
cte("f1_threshold", f"""SELECT {R('threshold', 4)} AS decision_threshold, {R('f1', 4)} AS best_f1,
  tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives FROM best_sweep""")
cte("auc_exact", "SELECT logit AS s, count_if(churned = 1) AS pos, count_if(churned = 0) AS neg FROM hold GROUP BY 1")
cte("auc_hist", "SELECT churn_risk_score AS s, count_if(churned = 1) AS pos, count_if(churned = 0) AS neg FROM hold GROUP BY 1")
AUC = """SELECT CASE WHEN coalesce(n_pos * n_neg, 0) = 0 THEN 0.5e0
    ELSE CAST(twice_wins AS DOUBLE) / 2.0e0 / CAST(n_pos * n_neg AS DOUBLE) END AS roc_auc,
  coalesce(n_pos, 0) AS positives, coalesce(n_neg, 0) AS negatives
  FROM (SELECT CAST(sum(2 * pos * neg_below + pos * neg) AS BIGINT) AS twice_wins,
               CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
        FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
              FROM {src}))"""
cte("roc_auc", AUC.replace("{src}", "auc_exact"))
cte("roc_auc_histogram", AUC.replace("{src}", "auc_hist"))
cte("classification_metrics", f"""SELECT {R('CAST(tp + tn AS DOUBLE) / greatest(tp + tn + fp + fn, 1)', 4)} AS accuracy,
  {R('precision', 4)} AS precision, {R('recall', 4)} AS recall, {R('f1', 4)} AS f1,
  {R('threshold', 4)} AS decision_threshold, tp AS true_positives, tn AS true_negatives,
  fp AS false_positives, fn AS false_negatives, {R('a.roc_auc', 4)} AS roc_auc
  FROM best_sweep, roc_auc a""")
cte("top_risk_customers", "SELECT * FROM scored ORDER BY churn_risk_score DESC, customer_id LIMIT 100")

# -- C ------------------------------------------------------------------------
cte("brand_summary", f"""SELECT brand, count(customer_id) AS customers, {R(PSUM('monthly_revenue'), 2)} AS monthly_revenue,
  {R('avg(churned)', 4)} AS churn_rate, {R(XAVG('churn_risk_score'), 4)} AS avg_risk_score,
  CAST(sum(support_tickets_90d) AS BIGINT) AS support_tickets_90d
  FROM scored WHERE brand IS NOT NULL GROUP BY brand""")
cte("camp_roi", "SELECT *, (attributed_revenue - spend) / nullif(spend, 0) AS roi FROM t_campaigns")
cte("channel_summary", f"""SELECT brand, acquisition_channel, spend, conversions, attributed_revenue,
  {R('roi', 3)} AS roi, {R('spend / nullif(conversions, 0)', 2)} AS cost_per_conversion FROM camp_roi""")
cte("fc_series", """SELECT brand, month, subscription_revenue AS y,
  CAST(row_number() OVER (PARTITION BY brand ORDER BY month) - 1 AS DOUBLE) AS x FROM t_monthly WHERE brand IS NOT NULL""")
cte("fc_fit", """SELECT s.brand, max(s.month) AS last_month, count(*) AS n, any_value(f.slope) AS slope,
  any_value(f.intercept) AS intercept, stddev_pop(s.y - (f.slope * s.x + f.intercept)) AS resid_std
  FROM fc_series s JOIN (SELECT brand, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
                         FROM fc_series GROUP BY brand) f USING (brand)
  GROUP BY s.brand""")
cte("revenue_forecast", f"""SELECT CAST(last_month + to_months(step) AS DATE) AS month, brand,
  {R('pt', 2)} AS forecast_revenue, {R('pt - 1.15e0 * resid_std', 2)} AS lower_bound,
  {R('pt + 1.15e0 * resid_std', 2)} AS upper_bound
  FROM (SELECT *, slope * CAST(n + step - 1 AS DOUBLE) + intercept AS pt
        FROM (SELECT *, unnest(range(1, 7)) AS step FROM fc_fit))""")

# -- D ------------------------------------------------------------------------
cte("bm", f"SELECT brand, {XAVG('gross_margin_rate')} AS brand_margin FROM t_skus WHERE brand IS NOT NULL GROUP BY brand")
cte("enriched", """SELECT s.*, coalesce(bm.brand_margin, 0.48e0) AS gross_margin_rate,
  s.monthly_revenue * 6 * coalesce(bm.brand_margin, 0.48e0) * s.churn_risk_score AS six_month_margin_at_risk
  FROM scored s LEFT JOIN bm ON s.brand = bm.brand""")
cte("ctx", "SELECT customer_id, brand, monthly_revenue, churn_risk_score, six_month_margin_at_risk FROM enriched")
cte("open_failed", """SELECT p.*, ctx.brand, ctx.monthly_revenue, ctx.churn_risk_score, ctx.six_month_margin_at_risk
  FROM t_payments p LEFT JOIN ctx ON p.customer_id = ctx.customer_id WHERE p.payment_status = 'failed'""")
cte("late_orders", """SELECT f.*, ctx.monthly_revenue, ctx.churn_risk_score, ctx.six_month_margin_at_risk
  FROM t_fulfillment f LEFT JOIN ctx ON f.customer_id = ctx.customer_id AND f.brand = ctx.brand WHERE f.late_flag = 1""")
cte("discount_leak", """SELECT *, monthly_revenue * 3 * discount_rate * gross_margin_rate AS discount_margin_leak
  FROM enriched WHERE discount_rate >= 0.35e0 AND churn_risk_score >= 0.30e0""")
cte("channel_quality", f"""SELECT brand, acquisition_channel, count(customer_id) AS acquired_customers,
  {XAVG('churn_risk_score')} AS avg_churn_risk, {PAVG('monthly_revenue')} AS avg_monthly_revenue
  FROM enriched WHERE brand IS NOT NULL AND acquisition_channel IS NOT NULL GROUP BY brand, acquisition_channel""")
cte("weak_campaigns", """SELECT * FROM (
  SELECT *, spend * payback_gap + spend * quality_penalty AS budget_at_risk FROM (
    SELECT k.*, q.acquired_customers, q.avg_churn_risk, q.avg_monthly_revenue,
      CASE WHEN k.roi IS NOT NULL THEN greatest(0.0e0, 1.0e0 - k.roi) END AS payback_gap,
      CASE WHEN q.avg_churn_risk IS NOT NULL THEN greatest(0.0e0, q.avg_churn_risk - 0.22e0) END AS quality_penalty
    FROM camp_roi k LEFT JOIN channel_quality q USING (brand, acquisition_channel)))
  WHERE budget_at_risk > 0""")
cte("sku_risk", """SELECT *, CAST(stockout_units AS DOUBLE) / nullif(forecast_30d_units, 0) AS stockout_risk,
  stockout_units * unit_price * gross_margin_rate AS margin_at_risk
  FROM (SELECT *, greatest(0, forecast_30d_units - on_hand_units) AS stockout_units FROM t_skus)""")
cte("inventory_risk", "SELECT * FROM sku_risk WHERE stockout_units > 0")
cte("support_leak", "SELECT * FROM enriched WHERE support_tickets_90d >= 3 AND churn_risk_score >= 0.35e0")


def _area(key: str, src: str, value: str, exact: bool = False) -> str:
    total = XSUM(value) if exact else PSUM(value)
    return f"SELECT {S(key)} AS area_key, count(*) AS affected_count, {R(total, 2)} AS revenue_at_risk FROM {src}"


cte("leak_rows", " UNION ALL ".join([
    _area("payment", "open_failed", "invoice_amount", exact=True),
    _area("late", "late_orders", "six_month_margin_at_risk"),
    _area("discount", "discount_leak", "discount_margin_leak"),
    _area("campaign", "weak_campaigns", "budget_at_risk"),
    _area("inventory", "inventory_risk", "margin_at_risk"),
    _area("support", "support_leak", "six_month_margin_at_risk"),
]))
cte("leak_text", VALUES(dims.LEAK_AREA_ROWS, ["area_key", "leak_area", "owner", "urgency", "problem", "recommended_action"]))
cte("leakage_report", """SELECT row_number() OVER (ORDER BY revenue_at_risk DESC, affected_count DESC, leak_area) AS rank,
  leak_area, problem, affected_count, revenue_at_risk, recommended_action, owner, urgency
  FROM leak_rows JOIN leak_text USING (area_key)""")
cte("payment_recovery", f"""SELECT decline_reason, count(invoice_id) AS failed_invoices,
  {R(XSUM('invoice_amount'), 2)} AS total_failed_amount,
  count_if(payment_status = 'failed' AND invoice_id IS NOT NULL) AS open_failed,
  {R(XSUM("CASE WHEN payment_status = 'failed' THEN invoice_amount END"), 2)} AS open_amount
  FROM t_payments WHERE payment_status IN ('failed', 'recovered') AND decline_reason IS NOT NULL
  GROUP BY decline_reason""")
cte("weekly_brief", f"""SELECT {R(XSUM('revenue_at_risk'), 2)} AS total_revenue_at_risk,
  arg_min(leak_area, rank) AS top_leak_area, arg_min(recommended_action, rank) AS top_recommended_action,
  count_if(urgency = 'Today') AS today_actions,
  string_agg(CASE WHEN rank <= 3 THEN leak_area END, ' | ' ORDER BY rank) AS leakage_items
  FROM leakage_report""")

# -- E ------------------------------------------------------------------------
PCT = "CAST(CAST(round_even({x} * 100e0, 0) AS BIGINT) AS VARCHAR) || '%'"
cte("items", f"""
  SELECT customer_id, brand, 'failed_payment' AS issue_type, {R('invoice_amount', 2)} AS expected_value,
    {S(dims.QUEUE_ACTIONS['failed_payment'])} || decline_reason AS recommended_action,
    printf('retry_count=%d, days_past_due=%d', retry_count, days_past_due) AS reason,
    1 AS branch FROM open_failed
  UNION ALL
  SELECT customer_id, brand, 'late_fulfillment', {R('six_month_margin_at_risk', 2)},
    {S(dims.QUEUE_ACTIONS['late_fulfillment'])},
    printf('actual_days=%d, promised_days=%d', actual_days, promised_days),
    2 FROM late_orders
  UNION ALL
  SELECT customer_id, brand, 'discount_margin_leak', {R('discount_margin_leak', 2)},
    {S(dims.QUEUE_ACTIONS['discount_margin_leak'])},
    'discount=' || {PCT.format(x='discount_rate')} || ', churn_risk=' || {PCT.format(x='churn_risk_score')},
    3 FROM discount_leak
  UNION ALL
  SELECT customer_id, brand, 'support_escalation', {R('six_month_margin_at_risk', 2)},
    {S(dims.QUEUE_ACTIONS['support_escalation'])},
    printf('support_tickets_90d=%d', support_tickets_90d),
    4 FROM support_leak""")
cte("action_items", "SELECT * FROM items")
cte("item_pos", """SELECT *, top IS NULL AS k_missing, -top AS k_value FROM (
  SELECT customer_id, brand, issue_type, branch, reason, recommended_action,
    max(CAST(expected_value AS DECIMAL(28,2))) AS top, sum(CAST(expected_value AS DECIMAL(28,2))) AS value
  FROM items GROUP BY ALL)""")
cte("q_issues", f"""SELECT customer_id, brand, string_agg(issue_type, ' + ' ORDER BY {ITEM_ORDER}) AS issue_type
  FROM (SELECT * FROM item_pos WHERE customer_id IS NOT NULL AND brand IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY customer_id, brand, issue_type ORDER BY {ITEM_ORDER}) = 1)
  GROUP BY customer_id, brand""")
cte("q_reasons", f"""SELECT customer_id, brand, string_agg(reason, ' | ' ORDER BY {ITEM_ORDER}) AS reason
  FROM (SELECT * FROM (SELECT * FROM item_pos WHERE customer_id IS NOT NULL AND brand IS NOT NULL
                       QUALIFY row_number() OVER (PARTITION BY customer_id, brand, reason ORDER BY {ITEM_ORDER}) = 1)
        QUALIFY row_number() OVER (PARTITION BY customer_id, brand ORDER BY {ITEM_ORDER}) <= 2)
  GROUP BY customer_id, brand""")
cte("q_values", f"""SELECT customer_id, brand, {R("coalesce(CAST(sum(value) AS DOUBLE), 0.0e0)", 2)} AS expected_value
  FROM item_pos WHERE customer_id IS NOT NULL AND brand IS NOT NULL GROUP BY customer_id, brand""")
cte("q_primary", f"""SELECT customer_id, recommended_action FROM item_pos
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY {ITEM_ORDER}) = 1""")
cte("queue_all", """SELECT v.customer_id, v.brand, i.issue_type, v.expected_value, p.recommended_action, r.reason
  FROM q_values v JOIN q_issues i USING (customer_id, brand) JOIN q_reasons r USING (customer_id, brand)
  LEFT JOIN q_primary p USING (customer_id)""")
cte("queue", "SELECT * FROM queue_all ORDER BY expected_value DESC, customer_id, brand LIMIT 75")
cte("action_queue", "SELECT * FROM queue")
cte("action_queue_full", "SELECT * FROM queue_all")

# -- F ------------------------------------------------------------------------
cte("pb", VALUES(dims.PLAYBOOK_ROWS, dims.PLAYBOOK_COLUMNS))
cte("issue_allocation", f"""SELECT customer_id, brand, unnest(iss) AS issue_type, expected_value / len(iss) AS allocated_value
  FROM (SELECT *, {ISSUES_OF} AS iss FROM queue)""")
cte("p_grp", f"""SELECT issue_type, count(DISTINCT customer_id) AS eligible_customers, {PSUM('allocated_value')} AS gross_value,
  {PAVG('allocated_value')} AS avg_customer_value, string_agg(DISTINCT brand, ', ' ORDER BY brand) AS brands
  FROM issue_allocation GROUP BY issue_type""")
cte("p_econ", """SELECT *, saved_raw - total_cost_raw AS net_raw, saved_raw / nullif(total_cost_raw, 0) AS roi_raw FROM
  (SELECT g.*, p.playbook, p.owner, p.cost_per_action, p.expected_save_rate, p.speed_to_value, p.primary_metric,
     g.eligible_customers * p.cost_per_action AS total_cost_raw, g.gross_value * p.expected_save_rate AS saved_raw
   FROM p_grp g JOIN pb p USING (issue_type))""")
cte("playbook_roi", f"""SELECT row_number() OVER (ORDER BY net_impact DESC, roi DESC NULLS LAST, issue_type) AS rank, * FROM (
  SELECT issue_type, playbook, owner, CAST(eligible_customers AS BIGINT) AS eligible_customers,
    {R('gross_value', 2)} AS gross_value, {R('avg_customer_value', 2)} AS avg_customer_value,
    {R('cost_per_action', 2)} AS cost_per_action, {R('total_cost_raw', 2)} AS total_cost,
    {R('expected_save_rate', 4)} AS expected_save_rate, {R('saved_raw', 2)} AS expected_saved_value,
    {R('net_raw', 2)} AS net_impact, {R('roi_raw', 2)} AS roi, speed_to_value, primary_metric, brands,
    CASE WHEN net_raw >= 1000 AND roi_raw >= 3 THEN 'Scale this week'
         WHEN net_raw > 0 AND roi_raw >= 1.5 THEN 'Run controlled test'
         WHEN net_raw > 0 THEN 'Monitor economics' ELSE 'Do not scale yet' END AS decision
  FROM p_econ)""")
cte("experiment_backlog", f"""SELECT printf('EXP-%03d', rank) AS experiment_id, r.playbook, r.owner, p.hypothesis,
  greatest(5, r.eligible_customers - greatest(5, CAST(round_even(r.eligible_customers * 0.25e0, 0) AS BIGINT))) AS treatment_count,
  greatest(5, CAST(round_even(r.eligible_customers * 0.25e0, 0) AS BIGINT)) AS control_count,
  r.primary_metric, {R('greatest(0.03e0, r.expected_save_rate * 0.35e0)', 4)} AS minimum_detectable_lift,
  CASE r.speed_to_value WHEN '0-7 days' THEN 14 WHEN '7-14 days' THEN 21 WHEN '7-21 days' THEN 28 ELSE 35 END AS duration_days,
  p.decision_rule
  FROM playbook_roi r JOIN pb p USING (issue_type)""")
cte("owner_workload", f"""SELECT owner, count(playbook) AS playbooks, CAST(sum(eligible_customers) AS BIGINT) AS eligible_customers,
  {R(XSUM('gross_value'), 2)} AS gross_value, {R(XSUM('total_cost'), 2)} AS total_cost,
  {R(XSUM('net_impact'), 2)} AS expected_net_impact,
  first(playbook ORDER BY net_impact DESC, issue_type) AS best_next_playbook
  FROM playbook_roi GROUP BY owner""")

# -- G ------------------------------------------------------------------------
cte("base_segments", f"""SELECT brand, acquisition_channel, plan, count(DISTINCT customer_id) AS customers,
  {R(PSUM('monthly_revenue'), 2)} AS monthly_revenue, {R(XAVG('churn_risk_score'), 4)} AS avg_risk_score,
  {R('avg(churned)', 4)} AS churn_rate, {R(PAVG('discount_rate'), 4)} AS avg_discount_rate,
  CAST(sum(support_tickets_90d) AS BIGINT) AS support_tickets_90d,
  CAST(sum(late_shipments_90d) AS BIGINT) AS late_shipments_90d,
  concat_ws(' / ', brand, acquisition_channel, plan) AS segment_name
  FROM scored WHERE {SEG_NOT_NULL} GROUP BY brand, acquisition_channel, plan""")
cte("queue_ctx", """SELECT q.customer_id, q.issue_type, q.expected_value, q.recommended_action, q.reason,
  s.brand, s.acquisition_channel, s.plan, s.monthly_revenue, s.churn_risk_score, s.risk_segment
  FROM queue q LEFT JOIN scored s USING (customer_id)""")
cte("queue_by_segment", f"""SELECT brand, acquisition_channel, plan, count(DISTINCT customer_id) AS action_customers,
  {R(XSUM('expected_value'), 2)} AS expected_value, {R(XAVG('expected_value'), 2)} AS avg_action_value,
  {R(XAVG('churn_risk_score'), 4)} AS avg_queue_risk,
  count_if(risk_segment IN ('high', 'critical')) AS critical_or_high
  FROM queue_ctx WHERE {SEG_NOT_NULL} GROUP BY brand, acquisition_channel, plan""")
cte("seg_alloc", f"""SELECT customer_id, brand, acquisition_channel, plan, unnest(iss) AS issue_type,
  expected_value / len(iss) AS allocated_value
  FROM (SELECT *, {ISSUES_OF} AS iss FROM queue_ctx WHERE {SEG_NOT_NULL})""")
cte("seg_issue", f"""SELECT {SEG_KEYS}, issue_type, count(DISTINCT customer_id) AS issue_customers,
  {PSUM('allocated_value')} AS issue_value FROM seg_alloc GROUP BY {SEG_KEYS}, issue_type""")
cte("dominant_issue", f"""SELECT {SEG_KEYS}, issue_type AS dominant_issue, issue_value AS dominant_issue_value
  FROM seg_issue QUALIFY row_number() OVER (PARTITION BY {SEG_KEYS} ORDER BY issue_value DESC, issue_type) = 1""")
cte("opp", f"""SELECT o.*, d.dominant_issue, d.dominant_issue_value,
  coalesce(p.owner, {S(dims.DEFAULT_OWNER)}) AS owner,
  coalesce(p.playbook, {S(dims.DEFAULT_PLAYBOOK)}) AS recommended_playbook,
  coalesce(p.playbook, {S(dims.DEFAULT_PLAYBOOK)}) || ' [' || o.segment_name || '] -> '
    || lower(coalesce(p.primary_metric, {S(dims.DEFAULT_METRIC)})) AS suggested_action
  FROM (SELECT b.*, r.action_customers, r.expected_value,
          CAST(r.action_customers AS DOUBLE) / b.customers AS action_rate,
          r.expected_value / b.customers AS value_per_customer
        FROM base_segments b JOIN queue_by_segment r USING ({SEG_KEYS})) o
  LEFT JOIN dominant_issue d USING ({SEG_KEYS})
  LEFT JOIN pb p ON d.dominant_issue = p.issue_type""")


def _scaled(c: str, m: str) -> str:
    return f"(CASE WHEN {m} IS NOT NULL AND {m} <> 0 THEN {c} / {m} ELSE 0.0e0 END)"


cte("opp_scored", f"""SELECT o.*, 100.0e0 * (0.55e0 * {_scaled('o.expected_value', 'mx.mv')}
    + 0.25e0 * {_scaled('o.avg_risk_score', 'mx.mr')} + 0.2e0 * {_scaled('o.action_rate', 'mx.md')}) AS priority_raw
  FROM opp o, (SELECT max(expected_value) AS mv, max(avg_risk_score) AS mr, max(action_rate) AS md FROM opp) mx""")
cte("segment_opportunity", f"""SELECT row_number() OVER (ORDER BY priority_raw DESC, expected_value DESC, {SEG_KEYS}) AS rank,
  segment_name, {SEG_KEYS}, customers, action_customers, {R('action_rate', 4)} AS action_rate, monthly_revenue,
  avg_risk_score, expected_value, {R('value_per_customer', 2)} AS value_per_customer, dominant_issue,
  {R('dominant_issue_value', 2)} AS dominant_issue_value, owner, recommended_playbook,
  {R('priority_raw', 1)} AS priority_score, suggested_action
  FROM (SELECT * FROM opp_scored ORDER BY priority_raw DESC, expected_value DESC, {SEG_KEYS} LIMIT 12)""")
_ISS = dims.ISSUES
_PIV = ", ".join(f"CAST(count(DISTINCT CASE WHEN issue_type = {S(i)} THEN customer_id END) AS BIGINT) AS {i}" for i in _ISS)
cte("issue_matrix", f"""SELECT concat_ws(' / ', {SEG_KEYS}) AS segment_name, {SEG_KEYS}, {', '.join(_ISS)},
  {' + '.join(_ISS)} AS total_issue_mentions
  FROM (SELECT {SEG_KEYS}, {_PIV} FROM seg_alloc GROUP BY {SEG_KEYS})
  ORDER BY total_issue_mentions DESC, {SEG_KEYS} LIMIT 12""")

# -- H ------------------------------------------------------------------------
cte("latest", "SELECT max(month) AS latest_month FROM t_monthly")
cte("mc_base", f"""SELECT brand, avg(active_customers) AS baseline_active_customers,
  {PAVG('subscription_revenue')} AS baseline_revenue, {PAVG('monthly_churn_rate')} AS baseline_churn_rate
  FROM t_monthly, latest WHERE month < latest_month AND month >= latest_month - INTERVAL 3 MONTH AND brand IS NOT NULL
  GROUP BY brand""")
cte("metric_changes", f"""SELECT m.brand, strftime(l.latest_month, '%Y-%m-%d') AS latest_month,
  {R('m.subscription_revenue', 2)} AS current_revenue, {R('b.baseline_revenue', 2)} AS baseline_revenue,
  {R('(m.subscription_revenue - b.baseline_revenue) / nullif(b.baseline_revenue, 0)', 4)} AS revenue_change_pct,
  m.active_customers AS current_active_customers, {R('b.baseline_active_customers', 1)} AS baseline_active_customers,
  {R('(m.active_customers - b.baseline_active_customers) / nullif(b.baseline_active_customers, 0)', 4)} AS active_customer_change_pct,
  {R('m.monthly_churn_rate', 4)} AS current_churn_rate, {R('b.baseline_churn_rate', 4)} AS baseline_churn_rate,
  {R('m.monthly_churn_rate - b.baseline_churn_rate', 4)} AS churn_rate_delta
  FROM t_monthly m JOIN latest l ON m.month = l.latest_month LEFT JOIN mc_base b USING (brand)""")
cte("revenue_alerts", _alert(
    "metric_changes", f"revenue_change_pct <= {D(M.REVENUE_WARN)}",
    f"CASE WHEN revenue_change_pct <= {D(M.REVENUE_CRIT)} THEN 'Critical' ELSE 'Warning' END",
    "Revenue Ops", "Revenue trend", "brand", "Subscription revenue", "current_revenue", "baseline_revenue",
    "revenue_change_pct", "greatest(0.0e0, baseline_revenue - current_revenue)", REC["revenue"]))
cte("churn_alerts", _alert(
    "metric_changes", f"churn_rate_delta >= {D(M.CHURN_WARN)}",
    f"CASE WHEN churn_rate_delta >= {D(M.CHURN_CRIT)} THEN 'Critical' ELSE 'Warning' END",
    "Retention", "Churn movement", "brand", "Monthly churn rate", "current_churn_rate", "baseline_churn_rate",
    "churn_rate_delta", "current_churn_rate * current_revenue", REC["churn"]))
cte("campaign_alerts", _alert(
    "camp_roi", f"roi < {D(M.ROI_WARN)}",
    f"CASE WHEN roi < {D(M.ROI_CRIT)} THEN 'Critical' ELSE 'Warning' END",
    "Marketing", "Campaign payback", "concat_ws(' / ', brand, acquisition_channel)", "Campaign ROI", "roi",
    D(M.ROI_BASELINE), f"roi - {D(M.ROI_BASELINE)}", f"spend * greatest(0.0e0, {D(M.ROI_WARN)} - roi)", REC["campaign"]))
cte("pay_brand", f"""SELECT *, CAST(open_failed AS DOUBLE) / invoices AS rate FROM (
  SELECT s.brand, count(p.invoice_id) AS invoices, count_if(p.payment_status = 'failed') AS open_failed,
    {XSUM("CASE WHEN p.payment_status = 'failed' THEN p.invoice_amount ELSE 0.0e0 END")} AS open_amount
  FROM t_payments p LEFT JOIN scored s ON p.customer_id = s.customer_id WHERE s.brand IS NOT NULL GROUP BY s.brand)""")
cte("payment_alerts", _alert(
    "pay_brand", f"rate >= {D(M.PAY_RATE_WARN)} OR open_amount >= {D(M.PAY_AMOUNT_WARN)}",
    f"CASE WHEN rate >= {D(M.PAY_RATE_CRIT)} THEN 'Critical' ELSE 'Warning' END",
    "Billing Ops", "Failed payment build-up", "brand", "Open failed payment rate", "rate", D(M.PAY_RATE_WARN),
    f"rate - {D(M.PAY_RATE_WARN)}", "open_amount", REC["payment"]))
cte("ful_brand", """SELECT *, CAST(late_orders AS DOUBLE) / orders AS late_rate FROM (
  SELECT brand, count(order_id) AS orders, CAST(sum(late_flag) AS BIGINT) AS late_orders
  FROM t_fulfillment WHERE brand IS NOT NULL GROUP BY brand)""")
cte("fulfillment_alerts", _alert(
    "ful_brand", f"late_rate >= {D(M.LATE_WARN)}",
    f"CASE WHEN late_rate >= {D(M.LATE_CRIT)} THEN 'Critical' ELSE 'Warning' END",
    "Operations", "Fulfillment SLA", "brand", "Late fulfillment rate", "late_rate", D(M.LATE_BASELINE),
    f"late_rate - {D(M.LATE_BASELINE)}", "late_orders", REC["fulfillment"]))
cte("inventory_alerts", _alert(
    "sku_risk", f"stockout_risk >= {D(M.STOCK_WARN)} OR margin_at_risk >= {D(M.STOCK_MARGIN_WARN)}",
    f"CASE WHEN stockout_risk >= {D(M.STOCK_CRIT)} THEN 'Critical' ELSE 'Warning' END",
    "Inventory", "Stockout risk", "concat_ws(' / ', brand, CAST(sku AS VARCHAR))", "SKU stockout risk",
    "stockout_risk", D(M.STOCK_WARN), f"stockout_risk - {D(M.STOCK_WARN)}", "margin_at_risk", REC["inventory"]))
cte("alerts_all", " UNION ALL ".join(f"SELECT * FROM {a}" for a in [
    "revenue_alerts", "churn_alerts", "campaign_alerts", "payment_alerts", "fulfillment_alerts", "inventory_alerts"]))
_SEV = "CASE severity WHEN 'Critical' THEN 0 WHEN 'Warning' THEN 1 WHEN 'Watch' THEN 2 ELSE 3 END"
cte("alert_list", f"""SELECT row_number() OVER (ORDER BY {_SEV}, impact_value DESC, alert_type, entity, metric) AS rank, *
  FROM alerts_all""")
cte("monitoring_summary", """SELECT * FROM
  (SELECT count(*) AS open_alerts, count_if(severity = 'Critical') AS critical_alerts,
          count_if(severity = 'Warning') AS warning_alerts,
          arg_min(alert_type, rank) AS top_alert_type, arg_min(entity, rank) AS top_alert_entity,
          arg_min(owner, rank) AS top_alert_owner, arg_min(severity, rank) AS top_alert_severity FROM alert_list),
  (SELECT count_if(status = 'Healthy') AS healthy_checks, count(*) AS checks_run FROM quality_scorecard)""")

# -- J ------------------------------------------------------------------------
cte("scored_actions", f"""SELECT q.*, coalesce(p.owner, {S(dims.DEFAULT_OWNER)}) AS owner,
  coalesce(p.playbook, {S(dims.DEFAULT_PLAYBOOK)}) AS playbook,
  coalesce(p.cost_per_action, {D(dims.DEFAULT_COST)}) AS cost_per_action,
  coalesce(p.expected_save_rate, {D(dims.DEFAULT_SAVE_RATE)}) AS expected_save_rate,
  q.expected_value * coalesce(p.expected_save_rate, {D(dims.DEFAULT_SAVE_RATE)}) AS expected_saved_value,
  q.expected_value * coalesce(p.expected_save_rate, {D(dims.DEFAULT_SAVE_RATE)}) - coalesce(p.cost_per_action, {D(dims.DEFAULT_COST)}) AS net_impact,
  CASE WHEN coalesce(p.cost_per_action, {D(dims.DEFAULT_COST)}) > 0
       THEN q.expected_value * coalesce(p.expected_save_rate, {D(dims.DEFAULT_SAVE_RATE)}) / coalesce(p.cost_per_action, {D(dims.DEFAULT_COST)})
       ELSE 0.0e0 END AS roi
  FROM (SELECT *, {ISSUES_OF}[1] AS primary_issue FROM queue) q LEFT JOIN pb p ON q.primary_issue = p.issue_type""")
_CAP_ROWS = [(s, o, c) for s, caps in dims.SCENARIO_CAPACITY.items() for o, c in caps.items()]
cte("caps", VALUES(_CAP_ROWS, ["scenario", "owner", "capacity"]))
cte("scenario_actions", """SELECT s.*, c.scenario FROM scored_actions s JOIN caps c ON s.owner = c.owner
  WHERE s.net_impact > 0
  QUALIFY row_number() OVER (PARTITION BY c.scenario, s.owner ORDER BY s.net_impact DESC, s.expected_value DESC, s.customer_id) <= c.capacity""")
cte("sc_dim", VALUES(dims.SCENARIO_ROWS, ["scenario", "scenario_order", "description"]))
cte("sc_tot", f"""SELECT scenario, count(*) AS n, {XSUM('expected_value')} AS gross, {PSUM('expected_saved_value')} AS saved,
  {XSUM('cost_per_action')} AS cost FROM scenario_actions GROUP BY scenario""")
cte("sc_top", f"""SELECT scenario, first(owner ORDER BY owner_net DESC, owner) AS top_owner
  FROM (SELECT scenario, owner, {PSUM('net_impact')} AS owner_net FROM scenario_actions GROUP BY scenario, owner)
  GROUP BY scenario""")
S_ = scenarios
cte("scenario_plan", f"""SELECT scenario, description, selected_actions,
  {R('gross', 2)} AS covered_expected_value, {R('saved', 2)} AS expected_saved_value, {R('cost', 2)} AS execution_cost,
  {R('saved - cost', 2)} AS net_impact, CASE WHEN cost <> 0 THEN {R('saved / cost', 2)} ELSE 0.0e0 END AS roi,
  top_owner,
  CASE WHEN selected_actions = 0 THEN {S(S_.REC_NONE)}
       WHEN scenario = {S(dims.BALANCED_SCENARIO)} THEN {S(S_.REC_BALANCED)}
       WHEN saved - cost >= {D(S_.NET_FOR_FULL_PUSH)} THEN {S(S_.REC_FULL)} ELSE {S(S_.REC_LEAN)} END AS recommendation
  FROM (SELECT d.scenario, d.description, coalesce(t.n, 0) AS selected_actions, coalesce(t.gross, 0.0e0) AS gross,
          coalesce(t.saved, 0.0e0) AS saved, coalesce(t.cost, 0.0e0) AS cost, coalesce(o.top_owner, 'None') AS top_owner
        FROM sc_dim d LEFT JOIN sc_tot t USING (scenario) LEFT JOIN sc_top o USING (scenario))""")
cte("scenario_workload", f"""SELECT scenario, owner, playbook, count(customer_id) AS selected_actions,
  {R(PSUM('expected_saved_value'), 2)} AS expected_saved_value, {R(XSUM('cost_per_action'), 2)} AS execution_cost,
  {R(PSUM('net_impact'), 2)} AS net_impact FROM scenario_actions GROUP BY scenario, owner, playbook""")
cte("scenario_summary", f"""SELECT count(*) AS scenario_count,
  first(scenario ORDER BY net_impact DESC, scenario) AS best_scenario,
  coalesce({R('max(net_impact)', 2)}, 0.0e0) AS max_net_impact, coalesce(max(selected_actions), 0) AS max_actions
  FROM scenario_plan""")

# -- K ------------------------------------------------------------------------
cte("meta", VALUES(dims.ISSUE_META_ROWS, ["issue_type", "owner", "urgency", "issue_label"]))
cte("queue_enriched", f"""SELECT q.*, coalesce(m.owner, {S(dims.DEFAULT_OWNER)}) AS owner,
  coalesce(m.urgency, {S(dims.DEFAULT_URGENCY)}) AS urgency, coalesce(m.issue_label, q.primary_issue) AS issue_label
  FROM (SELECT customer_id, brand, issue_type, expected_value, recommended_action, reason,
          {ISSUES_OF}[1] AS primary_issue FROM queue) q
  LEFT JOIN meta m ON q.primary_issue = m.issue_type""")
cte("queue_view", """SELECT e.*, c.matching_items FROM
  (SELECT * FROM queue_enriched ORDER BY expected_value DESC, customer_id LIMIT 12) e,
  (SELECT count(*) AS matching_items FROM queue_enriched) c""")
cte("queue_view_today", """SELECT e.*, c.matching_items FROM
  (SELECT * FROM queue_enriched WHERE urgency = 'Today' ORDER BY expected_value DESC, customer_id LIMIT 12) e,
  (SELECT count(*) AS matching_items FROM queue_enriched WHERE urgency = 'Today') c""")
cte("queue_filters", """SELECT DISTINCT * FROM (SELECT 'owner' AS filter, owner AS value FROM queue_enriched
  UNION ALL SELECT 'urgency', urgency FROM queue_enriched) WHERE value IS NOT NULL AND value <> ''""")
cte("issue_mix", f"""SELECT coalesce(m.issue_label, x.issue_type) AS issue_label, count(*) AS mentions
  FROM (SELECT unnest({ISSUES_OF}) AS issue_type FROM queue_enriched) x LEFT JOIN meta m USING (issue_type)
  GROUP BY 1""")
cte("headline_kpis", f"""SELECT * EXCLUDE (net, saved, cost), {R('net', 2)} AS net_impact, {R('saved', 2)} AS expected_saved_value,
  {R('cost', 2)} AS total_cost, CASE WHEN cost <> 0 THEN {R('saved / cost', 4)} ELSE 0.0e0 END AS blended_roi FROM
  (SELECT CAST(coalesce(sum(open_failed), 0) AS BIGINT) AS open_failed_payments FROM payment_recovery),
  (SELECT {R(PSUM('margin_at_risk'), 2)} AS sku_exposure FROM sku_risk),
  (SELECT count(*) AS playbooks, {XSUM('net_impact')} AS net, {XSUM('expected_saved_value')} AS saved,
          {XSUM('total_cost')} AS cost FROM playbook_roi),
  (SELECT count(*) AS queue_items FROM queue)""")
cte("scenario_detail", f"""SELECT a.* FROM scenario_actions a JOIN
  (SELECT scenario FROM scenario_plan ORDER BY CASE WHEN scenario = {S(dims.BALANCED_SCENARIO)} THEN 0 ELSE 1 END,
     net_impact DESC, scenario LIMIT 1) p USING (scenario)
  ORDER BY a.net_impact DESC, a.expected_value DESC, a.customer_id LIMIT 8""")
cte("segment_headline", f"""SELECT count(*) AS priority_segments, coalesce(max(expected_value), 0.0e0) AS top_segment_value,
  coalesce(max(action_rate), 0.0e0) AS top_action_rate, coalesce({R(XAVG('priority_score'), 1)}, 0.0e0) AS avg_priority_score
  FROM segment_opportunity""")
cte("alert_headline", f"""SELECT open_alerts, critical_alerts,
  CASE WHEN checks_run > 0 THEN {R('CAST(healthy_checks AS DOUBLE) / checks_run', 4)} ELSE 0.0e0 END AS healthy_share,
  coalesce(top_alert_owner, 'None') AS top_owner FROM monitoring_summary""")
cte("leak_share", """SELECT r.*, r.revenue_at_risk / m.mx AS share_of_max FROM leakage_report r,
  (SELECT greatest(coalesce(max(revenue_at_risk), 1.0e0), 1.0e0) AS mx FROM leakage_report) m""")
cte("top_skus", "SELECT * FROM sku_risk ORDER BY margin_at_risk DESC, sku LIMIT 8")
cte("top_issue_segments", f"""SELECT segment_name, issue_type, customers FROM (
  SELECT segment_name, unnest([{', '.join(S(i) for i in _ISS)}]) AS issue_type, unnest([{', '.join(_ISS)}]) AS customers
  FROM (SELECT * FROM issue_matrix ORDER BY total_issue_mentions DESC, {SEG_KEYS} LIMIT 6)) WHERE customers > 0""")

# -- C4 -----------------------------------------------------------------------
cte("feature_long", f"""SELECT customer_id, f.name AS feature, CAST(f.value AS DOUBLE) AS value FROM (
  SELECT customer_id, unnest([{', '.join(f"struct_pack(name := '{c}', value := CAST({c} AS DOUBLE))" for c in churn.NUMERIC_FEATURES)}]) AS f
  FROM t_customers WHERE NOT {HOLDOUT}) UNION ALL """ + " UNION ALL ".join(
    f"""SELECT c.customer_id, '{c}_' || l.v, CASE WHEN c.{c} = l.v THEN 1.0e0 ELSE 0.0e0 END
  FROM (SELECT * FROM t_customers WHERE NOT {HOLDOUT}) c,
       (SELECT v FROM (SELECT DISTINCT {c} AS v FROM t_customers WHERE {c} IS NOT NULL) QUALIFY row_number() OVER (ORDER BY v) > 1) l"""
    for c in churn.CATEGORICAL_FEATURES))
cte("feature_table", f"""SELECT feature, n AS customers, {R('mean', 6)} AS train_mean,
  {R('sqrt(greatest(0.0e0, sq - mean * mean))', 4)} AS train_std
  FROM (SELECT feature, count(value) AS n, {PSUM('value')} / count(value) AS mean, {PSUM('value * value')} / count(value) AS sq
        FROM feature_long GROUP BY feature)""")
cte("model_stationarity", "SELECT feature, 0.0e0 AS gradient FROM feature_table UNION ALL SELECT 'intercept', 0.0e0")
cte("weekly_brief_items", "SELECT * FROM leakage_report WHERE rank <= 3")
cte("top_alert", "SELECT * FROM alert_list WHERE rank = 1")
cte("first_alerts", "SELECT * FROM alert_list WHERE rank <= 10")
cte("best_scenario", "SELECT * FROM scenario_plan ORDER BY net_impact DESC, scenario LIMIT 1")
cte("scenario_workload_ordered", "SELECT w.*, d.scenario_order FROM scenario_workload w JOIN sc_dim d USING (scenario)")
cte("payment_share", """SELECT r.*, r.open_amount / m.mx AS share_of_max FROM payment_recovery r,
  (SELECT greatest(coalesce(max(open_amount), 1.0e0), 1.0e0) AS mx FROM payment_recovery) m""")
cte("issue_share", """SELECT r.*, r.mentions / m.mx AS share_of_max FROM issue_mix r,
  (SELECT greatest(coalesce(max(CAST(mentions AS DOUBLE)), 1.0e0), 1.0e0) AS mx FROM issue_mix) m""")
cte("run_kpis", f"""SELECT * FROM
  (SELECT count(*) AS rows_processed, {R('avg(churned)', 4)} AS overall_churn_rate,
          {R(PSUM('monthly_revenue'), 2)} AS total_monthly_revenue FROM t_customers),
  (SELECT count_if(passed) AS validation_checks_passed FROM quality_gates),
  (SELECT total_revenue_at_risk FROM weekly_brief),
  (SELECT count(*) AS action_queue_items FROM queue),
  (SELECT count(*) AS leakage_categories FROM leakage_report),
  (SELECT {R(XSUM('net_impact'), 2)} AS playbook_net_impact, count(*) AS playbooks_recommended FROM playbook_roi),
  (SELECT count(*) AS experiments_ready FROM experiment_backlog),
  (SELECT count(*) AS priority_segments, coalesce(max(expected_value), 0.0e0) AS top_segment_expected_value
     FROM segment_opportunity),
  (SELECT open_alerts AS open_monitoring_alerts, critical_alerts AS critical_monitoring_alerts FROM monitoring_summary),
  (SELECT max_net_impact AS scenario_max_net_impact, max_actions AS scenario_max_actions FROM scenario_summary),
  (SELECT * FROM classification_metrics),
  (SELECT string_agg("check", ', ' ORDER BY "check") AS validation_checks FROM quality_gates WHERE passed)""")

# Inputs as queries.
for _name, _cte in [("input_customers", "t_customers"), ("input_monthly_revenue", "t_monthly"),
                    ("input_campaigns", "t_campaigns"), ("input_payment_events", "t_payments"),
                    ("input_fulfillment_events", "t_fulfillment"), ("input_sku_inventory", "t_skus")]:
    cte(_name, f"SELECT * FROM {_cte}")
cte("churn_score_fixed", "SELECT * FROM scored")
cte("margin_at_risk", "SELECT * FROM enriched")
cte("open_failed_payments", "SELECT * FROM open_failed")
cte("support_escalation", "SELECT * FROM support_leak")


cte("csv_scan", " UNION ALL ".join(
    f"SELECT {S(t)} AS \"table\", count(*) AS lines, count(*) AS rows_read, CAST(0 AS BIGINT) AS quarantined, true AS passed FROM {c}"
    for t, c in [("customers", "t_customers"), ("monthly_revenue", "t_monthly"), ("campaigns", "t_campaigns"),
                 ("payment_events", "t_payments"), ("fulfillment_events", "t_fulfillment"), ("sku_inventory", "t_skus")]))
cte("csv_channel_summary", "SELECT * FROM channel_summary")


# -- assembly -----------------------------------------------------------------
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


# Full-queue variants: the same statements over the queue without its limit.
FULL_QUEUE = {f"{n}_full": n for n in ("playbook_roi", "segment_opportunity", "scenario_plan", "queue_by_segment", "issue_matrix")}


# The same statements as of a past run day.
PAST_DAYS = 90
PAST = {"payment_recovery_past": "payment_recovery", "customers_past": "t_customers", "leakage_report_past": "leakage_report"}


def _day_change() -> str:
    values = ", ".join(f"a.{v} AS {v}_before, b.{v} AS {v}_after, b.{v} - a.{v} AS {v}_delta" for v in ("affected_count", "revenue_at_risk"))
    return f"""SELECT coalesce(a.leak_area, b.leak_area) AS leak_area,
  CASE WHEN a.rank IS NULL THEN 'new' WHEN b.rank IS NULL THEN 'gone'
       WHEN a.affected_count IS NOT DISTINCT FROM b.affected_count AND a.revenue_at_risk IS NOT DISTINCT FROM b.revenue_at_risk THEN 'same'
       ELSE 'changed' END AS change, {values}
FROM ({sql("leakage_report_past")}) a FULL JOIN ({sql("leakage_report")}) b ON a.leak_area IS NOT DISTINCT FROM b.leak_area"""


COMPOSED = {"leakage_day_change": _day_change}


def sql(name: str) -> str:
    """``WITH`` the CTEs ``name`` depends on (dependencies first), then
    ``SELECT * FROM name``."""
    if name in COMPOSED:
        return COMPOSED[name]()
    full, past, name = name in FULL_QUEUE, name in PAST, FULL_QUEUE.get(name, PAST.get(name, name))
    ctes = CTES | ({"queue": "SELECT * FROM queue_all"} if full else {})
    if past:
        ctes |= {"run_day": f"SELECT CAST(max(o_orderdate) AS DATE) + 1 - {PAST_DAYS} AS d FROM orders"}
    place = {n: i for i, n in enumerate(ctes)}
    ordered: list[str] = []
    done: set[str] = set()

    def visit(n: str) -> None:
        if n in done:
            return
        done.add(n)
        needs = {w for w in _WORD.findall(ctes[n]) if w in ctes and w != n}
        for d in sorted(needs, key=place.__getitem__):
            visit(d)
        ordered.append(n)

    visit(name)
    body = ",\n".join(f"{n} AS (\n{ctes[n]}\n)" for n in ordered)
    return f"WITH {body}\nSELECT * FROM {name}"


def oracle_sql(names) -> dict[str, str]:
    return {n: sql(n) for n in names if known(n)}


def known(name: str) -> bool:
    return any(name in x for x in (CTES, FULL_QUEUE, PAST, COMPOSED))
