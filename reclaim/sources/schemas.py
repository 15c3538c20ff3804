"""Explicit schemas of the six input tables (no inference at scale)."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# customer_id is a string in CSV extracts and a long in the warehouse
# adapter; operators only need it to be an equi-join key.
CUSTOMERS = _struct(
    ("customer_id", S),
    ("brand", S),
    ("region", S),
    ("acquisition_channel", S),
    ("plan", S),
    ("tenure_months", I),
    ("active_subscriptions", I),
    ("monthly_revenue", D),
    ("discount_rate", D),
    ("support_tickets_90d", I),
    ("late_shipments_90d", I),
    ("email_engagement", D),
    ("avg_days_between_orders", D),
    ("churned", I),
)

MONTHLY_REVENUE = _struct(
    ("month", T.DateType()),
    ("brand", S),
    ("active_customers", I),
    ("subscription_revenue", D),
    ("monthly_churn_rate", D),
)

CAMPAIGNS = _struct(
    ("brand", S),
    ("acquisition_channel", S),
    ("spend", D),
    ("conversions", I),
    ("attributed_revenue", D),
)

PAYMENT_EVENTS = _struct(
    ("invoice_id", S),
    ("customer_id", S),
    ("invoice_amount", D),
    ("payment_status", S),
    ("decline_reason", S),
    ("retry_count", I),
    ("days_past_due", I),
)

FULFILLMENT_EVENTS = _struct(
    ("order_id", S),
    ("customer_id", S),
    ("brand", S),
    ("sku", S),
    ("promised_days", I),
    ("actual_days", I),
    ("late_flag", I),
    ("fulfillment_status", S),
)

SKU_INVENTORY = _struct(
    ("sku", S),
    ("brand", S),
    ("category", S),
    ("on_hand_units", I),
    ("forecast_30d_units", I),
    ("unit_price", D),
    ("gross_margin_rate", D),
    ("supplier_lead_time_days", I),
)

INPUTS = {
    "customers": CUSTOMERS,
    "monthly_revenue": MONTHLY_REVENUE,
    "campaigns": CAMPAIGNS,
    "payment_events": PAYMENT_EVENTS,
    "fulfillment_events": FULFILLMENT_EVENTS,
    "sku_inventory": SKU_INVENTORY,
}

CUSTOMER_REQUIRED = [f.name for f in CUSTOMERS.fields]
