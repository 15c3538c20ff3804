"""A. Gates and data quality.

Every check is one global aggregate per table (a single pass, partial
aggregation on each partition), turned into labelled rows with ``explode``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import attach, lazy
from ..sources.schemas import CUSTOMER_REQUIRED

GATE_NAMES = [
    "schema_check_passed",
    "missing_value_check_passed",
    "unique_customer_check_passed",
    "business_rule_check_passed",
]


def _null_count(df: DataFrame, columns: list[str]) -> Column:
    flags = [F.col(c).isNull().cast("long") for c in columns]
    return F.sum(reduce(lambda a, b: a + b, flags)) if flags else F.lit(0)


# Business rules by the column that they need.
RULES = {
    "monthly_revenue": lambda c: c > 0,
    "discount_rate": lambda c: c.between(0, 1),
    "churned": lambda c: c.isin(0, 1),
}


def _business_rules_ok(columns: list[str]) -> Column:
    """Whether a row keeps every rule whose column is there (a missing
    column is reported by the schema gate)."""
    present = [rule(F.col(c)) for c, rule in RULES.items() if c in columns]
    return F.coalesce(reduce(lambda a, b: a & b, present, F.lit(True)), F.lit(False))


def _duplicates(df: DataFrame) -> Column:
    """Rows whose customer_id another row has; NULL ids count as one id."""
    if "customer_id" not in df.columns:
        return F.lit(0)
    has_null = F.coalesce(F.max(F.col("customer_id").isNull().cast("long")), F.lit(0))
    return F.count(F.lit(1)) - F.count_distinct("customer_id") - has_null


def missing_columns(df: DataFrame, required: list[str] = CUSTOMER_REQUIRED) -> list[str]:
    return sorted(set(required) - set(df.columns))


def quality_gates(customers: DataFrame, required: list[str] = CUSTOMER_REQUIRED) -> DataFrame:
    """A1-A5: one row per gate with its failure count and pass flag."""
    missing = missing_columns(customers, required)
    present = [c for c in required if c in customers.columns]
    stats = customers.agg(
        F.coalesce(_null_count(customers, present), F.lit(0)).alias("nulls"),
        _duplicates(customers).alias("dups"),
        F.count_if(~_business_rules_ok(customers.columns)).alias("rule_failures"),
    )
    rows = F.array(
        F.struct(F.lit(GATE_NAMES[0]).alias("check"), F.lit(len(missing)).cast("long").alias("failures")),
        F.struct(F.lit(GATE_NAMES[1]).alias("check"), F.col("nulls").cast("long").alias("failures")),
        F.struct(F.lit(GATE_NAMES[2]).alias("check"), F.col("dups").cast("long").alias("failures")),
        F.struct(F.lit(GATE_NAMES[3]).alias("check"), F.col("rule_failures").cast("long").alias("failures")),
    )
    return (
        stats.select(F.explode(rows).alias("g"))
        .select("g.check", "g.failures")
        .withColumn("passed", F.col("failures") == 0)
    )


def validate_customers(customers: DataFrame) -> list[str]:
    """Raise on the first failed gate (one aggregate job); else the passed
    gate names."""
    missing = missing_columns(customers)
    if missing:
        raise ValueError(f"customer columns absent: {missing}")
    failures = {r["check"]: r["failures"] for r in quality_gates(customers).collect()}
    messages = {
        "missing_value_check_passed": "required customer fields hold nulls",
        "unique_customer_check_passed": "customer_id repeats",
        "business_rule_check_passed": "customer rule violated: " + ", ".join(RULES),
    }
    for name in GATE_NAMES[1:]:
        if failures[name]:
            raise ValueError(messages[name])
    return list(GATE_NAMES)


MOST_MALFORMED = 0.01  # share of an input's lines


def quarantine_gate(inputs: dict, most: float = MOST_MALFORMED) -> DataFrame:
    """One row per input (``sources.io.Checked``): lines, rows read, lines set
    apart as malformed, and whether these are few enough."""
    spark = next(iter(inputs.values())).rows.sparkSession
    rows = []
    for table, checked in inputs.items():
        # Both read the parsed table; counts need no column of it.
        read, bad = checked.rows.count(), checked.quarantine.count()
        rows.append((table, read + bad, read, bad, bad <= most * (read + bad)))
    return spark.createDataFrame(rows, "table string, lines long, rows_read long, quarantined long, passed boolean")


def check_quarantine(inputs: dict, most: float = MOST_MALFORMED) -> None:
    """Raise if an input has too many malformed lines."""
    failed = [r["table"] for r in quarantine_gate(inputs, most).collect() if not r["passed"]]
    if failed:
        raise ValueError(f"malformed lines over the limit: {sorted(failed)}")


# Scorecard thresholds (parameters with these defaults).
MIN_CUSTOMER_ROWS = 2500
MIN_MONTHS = 12
MIN_FULFILLMENT_ROWS = 1500
MIN_SKU_ROWS = 12
CAMPAIGN_INPUTS = ["spend", "attributed_revenue", "conversions"]


# Totals of each input that the scorecard needs.  Rows of a customer_id are
# counted first (``by_customer``): no DISTINCT, one read.
INPUT_TOTALS = {
    "customers": lambda: [
        F.coalesce(F.sum("rows"), F.lit(0)).alias("customer_rows"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("customer_dups"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("customer_nulls"),
    ],
    # One entry per calendar month at most.
    "monthly_revenue": lambda: [F.size(F.collect_set("month")).cast("long").alias("months")],
    "campaigns": lambda: [F.count(F.lit(1)).alias("campaign_rows")],
    "payment_events": lambda: [F.count(F.lit(1)).alias("payment_rows")],
    "fulfillment_events": lambda: [F.count(F.lit(1)).alias("fulfillment_rows")],
    "sku_inventory": lambda: [F.count(F.lit(1)).alias("sku_rows")],
}


def by_customer(customers: DataFrame) -> DataFrame:
    """Rows and missing cells of each customer_id (NULL counts as one id)."""
    nulls = F.coalesce(_null_count(customers, customers.columns), F.lit(0)).alias("nulls")
    return customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("rows"), nulls)


def quality_scorecard(
    customers: DataFrame,
    monthly: DataFrame,
    campaigns: DataFrame,
    payments: DataFrame,
    fulfillment: DataFrame,
    skus: DataFrame,
    min_customers: int = MIN_CUSTOMER_ROWS,
    min_months: int = MIN_MONTHS,
    min_fulfillment: int = MIN_FULFILLMENT_ROWS,
    min_skus: int = MIN_SKU_ROWS,
    total=lazy,
) -> DataFrame:
    """Eight checks -> check, value, status, owner, expectation.

    Each table contributes one row of totals (``INPUT_TOTALS``) by
    ``total(df, name, metrics)``: a plan, or what was observed when the table
    was written.
    """
    tables = {"customers": by_customer(customers), "monthly_revenue": monthly, "campaigns": campaigns,
              "payment_events": payments, "fulfillment_events": fulfillment, "sku_inventory": skus}
    one, *parts = [total(df, name, INPUT_TOTALS[name]()) for name, df in tables.items()]
    for part in parts:
        one = attach(one, part)
    has_campaign_inputs = set(CAMPAIGN_INPUTS).issubset(campaigns.columns)

    def row(check: str, value: Column, passed: Column, owner: str, expectation: str) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            value.cast("long").alias("value"),
            F.when(passed, "Healthy").otherwise("Needs review").alias("status"),
            F.lit(owner).alias("owner"),
            F.lit(expectation).alias("expectation"),
        )

    rows = F.array(
        row("Customer rows", F.col("customer_rows"), F.col("customer_rows") >= min_customers,
            "Data Engineering", f"value >= {min_customers}"),
        row("Customer duplicates", F.col("customer_dups"), F.col("customer_dups") == 0,
            "Data Engineering", "value = 0"),
        row("Customer missing values", F.col("customer_nulls"), F.col("customer_nulls") == 0,
            "Data Engineering", "value = 0"),
        row("Monthly revenue coverage", F.col("months"), F.col("months") >= min_months,
            "Analytics", f"value >= {min_months}"),
        row("Campaign ROI inputs", F.col("campaign_rows"), F.lit(has_campaign_inputs),
            "Marketing Ops", "columns: " + ", ".join(CAMPAIGN_INPUTS)),
        row("Payment events coverage", F.col("payment_rows"), F.col("payment_rows") == F.col("customer_rows"),
            "Billing Ops", "value = customer rows"),
        row("Fulfillment sample coverage", F.col("fulfillment_rows"), F.col("fulfillment_rows") >= min_fulfillment,
            "Operations", f"value >= {min_fulfillment}"),
        row("Inventory SKU coverage", F.col("sku_rows"), F.col("sku_rows") >= min_skus,
            "Inventory", f"value >= {min_skus}"),
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")
