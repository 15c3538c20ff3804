"""Derive the six subscription tables from a TPC-H style warehouse.

``region nation customer part orders lineitem`` become customers,
monthly_revenue, campaigns, payment_events, fulfillment_events and
sku_inventory.  Everything is relational: order roll-ups keyed by
customer, one recent-window join of lineitem to orders, and small
dimension lookups, so the work grows with the warehouse and every scan
gets its date filter and column list pushed down.

"Today" is a parameter (``Dates``).  By default it is the day after the last
order, so no order is ever later; the windows are day counts before it.
Shipments due after today belong to the recent window.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import cents, latest_per

RECENT_DAYS = 181
TICKET_DAYS = 90
CHURN_DAYS = 365
CAMPAIGN_DAYS = 92


@dataclass(frozen=True)
class Dates:
    """The run day and the windows before it, in days.

    ``as_of``: first day that is not part of the run; ``None`` takes the day
    after the last order, less ``days_back`` days.  Orders of that day and later
    count nowhere, nor do their shipments.  ``recent_days``: shipments read for fulfillment
    events, discount rates and part demand.  ``ticket_days``: shipments behind
    the 90-day ticket and late-shipment counts.  ``churn_days``: a customer
    whose last order is older has churned.  ``campaign_days``: orders that
    campaigns are credited with."""

    as_of: dt.date | None = None
    days_back: int = 0
    recent_days: int = RECENT_DAYS
    ticket_days: int = TICKET_DAYS
    churn_days: int = CHURN_DAYS
    campaign_days: int = CAMPAIGN_DAYS

# Label lists indexed by key modulo their length.
CHANNELS = ["paid_search", "affiliate", "display", "email", "organic"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
DECLINE_REASONS = ["expired_card", "insufficient_funds", "soft_decline", "authentication_required", "gateway_issue"]
ENGAGED_PRIORITIES = ["1-URGENT", "2-HIGH"]

# Fixed churn-score coefficients (intercept first).
SCORE_INTERCEPT = -0.6
SCORE_COEF = {
    "discount_rate": 1.9,
    "support_tickets_90d": 0.33,
    "late_shipments_90d": 0.23,
    "email_engagement": -1.35,
    "tenure_months": -0.012,  # applied to (tenure - 60)
    "avg_days_between_orders": 0.0015,
}
TENURE_CENTER = 60


def _ts(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("timestamp_ntz")


def _pick(labels: list[str], key: Column) -> Column:
    """labels[key % len(labels)] as a CASE expression (stays in codegen)."""
    k = F.pmod(key, F.lit(len(labels)))
    out = None
    for i, label in enumerate(labels):
        out = F.when(k == i, F.lit(label)) if out is None else out.when(k == i, F.lit(label))
    return out


class Warehouse:
    """Lazy handles on the warehouse tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, path: str, share=None, dates: Dates = Dates(),
                 customers_without_orders: bool = False):
        """``share(df, name)``, when given, materializes the recent-window
        join, which two inputs (customers, fulfillment events) read.  A
        customer without an order has no subscription and is left out, unless
        ``customers_without_orders`` keeps it with zeros."""
        self.spark = spark
        self.dates = dates
        self.customers_without_orders = customers_without_orders
        self._as_of = dates.as_of
        self.path = path.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._share = share
        self._recent: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        # One handle per table: the file listing and footer read happen once.
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._tables[name]

    @property
    def as_of(self) -> dt.date:
        """The run day; read once from the orders when it is not given."""
        if self._as_of is None:
            last = self.table("orders").agg(F.max("o_orderdate").cast("date")).first()[0]
            self._as_of = (last or dt.date(1970, 1, 1)) + dt.timedelta(days=1 - self.dates.days_back)
        return self._as_of

    def days_before(self, days: int) -> Column:
        return _ts(self.as_of - dt.timedelta(days=days))

    # -- shared building blocks -------------------------------------------
    def orders_before(self) -> DataFrame:
        return self.table("orders").where(F.col("o_orderdate") < _ts(self.as_of))

    def window_lines(self) -> DataFrame:
        """Lineitems shipped in the recent window, or due later (pushed into
        the scan)."""
        return self.table("lineitem").where(F.col("l_shipdate") >= self.days_before(self.dates.recent_days))

    def recent_lines(self) -> DataFrame:
        """Window lineitems of the orders of the run, with their customer."""
        if self._recent is None:
            lines = self.window_lines().select(
                "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus",
                "l_shipdate",
            )
            orders = self.orders_before().select("o_orderkey", "o_custkey")
            joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            self._recent = self._share(joined, "recent_lines") if self._share else joined
        return self._recent

    def customer_brand(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey"), F.col("c_mktsegment").alias("brand"))


def channel_of(custkey: Column) -> Column:
    return _pick(CHANNELS, custkey)


def plan_of(custkey: Column) -> Column:
    k = F.pmod(custkey, F.lit(7))
    return F.when(k <= 3, "monthly").when(k <= 5, "quarterly").otherwise("annual")


def customers(wh: Warehouse) -> DataFrame:
    o = wh.orders_before()
    order_totals = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_open"),
        F.sum(cents("o_totalprice")).alias("price_cents"),
        F.count_if(F.col("o_orderpriority").isin(ENGAGED_PRIORITIES)).alias("n_engaged"),
    )
    counted = F.col("l_shipdate") >= wh.days_before(wh.dates.ticket_days)
    recent = wh.recent_lines().groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(cents("l_discount")).alias("discount_cents"),
        F.count_if(counted & (F.col("l_returnflag") == "R")).alias("n_returned"),
        F.count_if(counted & (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")).alias("n_late"),
    )
    geo = wh.table("nation").join(wh.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    base = wh.table("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    joined = (
        base.join(geo, base.c_nationkey == geo.n_nationkey)
        .join(order_totals, "c_custkey", "left" if wh.customers_without_orders else "inner")
        .join(recent, "c_custkey", "left")
    )
    as_of_month = wh.as_of.year * 12 + wh.as_of.month
    tenure = F.lit(as_of_month) - (F.year("first_order") * 12 + F.month("first_order"))
    tenure = F.coalesce(tenure, F.lit(0))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    span_days = F.datediff(F.col("last_order").cast("date"), F.col("first_order").cast("date"))
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("brand"),
        F.col("r_name").alias("region"),
        channel_of(F.col("c_custkey")).alias("acquisition_channel"),
        plan_of(F.col("c_custkey")).alias("plan"),
        tenure.cast("int").alias("tenure_months"),
        zero("n_open").cast("int").alias("active_subscriptions"),
        (zero("price_cents").cast("double") / F.lit(100000.0) / F.greatest(tenure, F.lit(1))).alias(
            "monthly_revenue"
        ),
        F.coalesce(
            F.least(
                F.lit(0.55),
                F.lit(5.0) * F.col("discount_cents").cast("double") / (F.lit(100.0) * F.col("n_lines")),
            ),
            F.lit(0.0),
        ).alias("discount_rate"),
        F.coalesce(F.col("n_returned"), F.lit(0)).cast("int").alias("support_tickets_90d"),
        F.coalesce(F.col("n_late"), F.lit(0)).cast("int").alias("late_shipments_90d"),
        (zero("n_engaged").cast("double") / F.greatest(zero("n_orders"), F.lit(1))).alias("email_engagement"),
        F.when(F.col("n_orders").isNull(), F.lit(0.0))
        .when(F.col("n_orders") == 1, F.lit(30.0))
        .otherwise(span_days.cast("double") / (F.col("n_orders") - 1))
        .alias("avg_days_between_orders"),
        F.when(F.col("last_order") < wh.days_before(wh.dates.churn_days), 1).otherwise(0).alias("churned"),
    )


def monthly_revenue(wh: Warehouse) -> DataFrame:
    o = wh.orders_before().join(wh.customer_brand(), F.col("o_custkey") == F.col("c_custkey"))
    return (
        o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"), "brand")
        .agg(
            F.count_distinct("o_custkey").cast("int").alias("active_customers"),
            (F.sum(cents("o_totalprice")).cast("double") / F.lit(100000.0)).alias("subscription_revenue"),
            (
                F.count_if((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")).cast("double")
                / F.count(F.lit(1))
            ).alias("monthly_churn_rate"),
        )
    )


def campaigns(wh: Warehouse) -> DataFrame:
    o = wh.orders_before().where(F.col("o_orderdate") >= wh.days_before(wh.dates.campaign_days))
    c = wh.customer_brand()
    paid = F.col("o_orderstatus") == "P"
    return (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("brand", channel_of(F.col("c_custkey")).alias("acquisition_channel"))
        .agg(
            (F.coalesce(F.sum(F.when(paid, cents("o_totalprice"))), F.lit(0)).cast("double") / F.lit(10000.0)).alias(
                "spend"
            ),
            F.count(F.lit(1)).cast("int").alias("conversions"),
            (
                F.coalesce(F.sum(F.when(~paid, cents("o_totalprice"))), F.lit(0)).cast("double") / F.lit(10000.0)
            ).alias("attributed_revenue"),
        )
    )


def payment_events(wh: Warehouse) -> DataFrame:
    """Each customer's latest order (largest key) before the run day as the
    current invoice.  The status is encoded as a number before aggregating, so
    the roll-up (``latest_per``) hashes."""
    o = wh.orders_before()
    is_f = F.col("o_orderstatus") == "F"
    code = (
        F.when(is_f & (F.col("o_orderpriority") == "1-URGENT"), 2)
        .when(is_f & (F.col("o_orderpriority") == "2-HIGH"), 1)
        .otherwise(0)
    )
    last = latest_per(o, "o_custkey", "o_orderkey", price=F.col("o_totalprice"), code=code).withColumnRenamed("o_orderkey", "key")
    key = F.col("key")
    status = F.when(F.col("code") == 2, "failed").when(F.col("code") == 1, "recovered").otherwise("paid")
    declined = F.col("code") > 0
    return last.select(
        key.alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        (F.col("price") / F.lit(1000.0)).alias("invoice_amount"),
        status.alias("payment_status"),
        F.when(declined, _pick(DECLINE_REASONS, key)).otherwise("none").alias("decline_reason"),
        F.when(declined, 1 + F.pmod(key, F.lit(3))).otherwise(0).cast("int").alias("retry_count"),
        F.when(F.col("code") == 2, 1 + F.pmod(key, F.lit(17))).otherwise(0).cast("int").alias("days_past_due"),
    )


def fulfillment_events(wh: Warehouse) -> DataFrame:
    lines = wh.recent_lines().join(wh.customer_brand(), F.col("o_custkey") == F.col("c_custkey"))
    promised = F.lit(2) + F.pmod(F.col("l_linenumber"), F.lit(4))
    actual = F.greatest(F.lit(1), promised + F.pmod(F.col("l_quantity"), F.lit(5.0)).cast("int") - 1)
    late = actual > promised + 1
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        "brand",
        F.col("l_partkey").alias("sku"),
        promised.cast("int").alias("promised_days"),
        actual.cast("int").alias("actual_days"),
        late.cast("int").alias("late_flag"),
        F.when(late, "late").otherwise("on_time").alias("fulfillment_status"),
    )


def sku_inventory(wh: Warehouse) -> DataFrame:
    # Part demand needs no customer, so it skips the join to orders.  It is a
    # rate of the past: shipments that are only due do not count.
    demand = wh.window_lines().where(F.col("l_shipdate") < _ts(wh.as_of)).groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))
    p = wh.table("part")
    key = F.col("p_partkey")
    return p.join(demand, p.p_partkey == demand.l_partkey, "left").select(
        key.alias("sku"),
        _pick(SEGMENTS, key).alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("int").alias("on_hand_units"),
        F.coalesce(F.floor(F.col("qty") / F.lit(6.0)), F.lit(0)).cast("int").alias("forecast_30d_units"),
        (F.col("p_retailprice") / F.lit(10.0)).alias("unit_price"),
        (F.lit(0.34) + F.pmod(key, F.lit(35)).cast("double") / F.lit(100.0)).alias("gross_margin_rate"),
        (F.lit(8) + F.pmod(key, F.lit(23))).cast("int").alias("supplier_lead_time_days"),
    )


def fixed_score(customers_df: DataFrame) -> Column:
    """Churn logit with the fixed coefficients, evaluated left to right."""
    c = SCORE_COEF
    z = (
        F.lit(SCORE_INTERCEPT)
        + F.lit(c["discount_rate"]) * F.col("discount_rate")
        + F.lit(c["support_tickets_90d"]) * F.col("support_tickets_90d")
        + F.lit(c["late_shipments_90d"]) * F.col("late_shipments_90d")
        + F.lit(c["email_engagement"]) * F.col("email_engagement")
        + F.lit(c["tenure_months"]) * (F.col("tenure_months") - TENURE_CENTER)
        + F.lit(c["avg_days_between_orders"]) * F.col("avg_days_between_orders")
    )
    return z


BUILDERS = {
    "customers": customers,
    "monthly_revenue": monthly_revenue,
    "campaigns": campaigns,
    "payment_events": payment_events,
    "fulfillment_events": fulfillment_events,
    "sku_inventory": sku_inventory,
}


class Inputs(dict):
    """The six input tables, each built on first access."""

    def __init__(self, wh: Warehouse):
        super().__init__()
        self.wh = wh

    def __missing__(self, key: str) -> DataFrame:
        df = BUILDERS[key](self.wh)
        self[key] = df
        return df


def load(spark: SparkSession, sf_dir: str, share=None, dates: Dates = Dates(),
         customers_without_orders: bool = False) -> dict[str, DataFrame]:
    """The six inputs of a warehouse folder, built lazily.  ``share`` (e.g.
    ``session.materialize``) writes the recent-window join once for runs
    that build both inputs reading it."""
    return Inputs(Warehouse(spark, sf_dir, share, dates, customers_without_orders))
