import numpy as np
import pytest

from reclaim.operators import actions

ITEM_SCHEMA = ("customer_id long, brand string, issue_type string, expected_value double, "
               "recommended_action string, reason string, branch int")
ISSUES = list(actions.BRANCH_ORDER)


def _items(spark, rows):
    return spark.createDataFrame(rows, ITEM_SCHEMA)


def test_rollup_keeps_value_order_and_first_two_reasons(spark):
    rows = [
        (1, "B", "late_fulfillment", 50.0, "ship", "6 of 3 days", 2),
        (1, "B", "late_fulfillment", 50.0, "ship", "5 of 2 days", 2),
        (1, "B", "support_escalation", 50.0, "call", "3 tickets", 4),
        (1, "B", "failed_payment", 80.0, "pay", "1 retry", 1),
        (2, None, "failed_payment", 999.0, "pay", "1 retry", 1),  # unknown customer
        (3, "C", "discount_margin_leak", 10.0, "offer", "deep discount", 3),
    ]
    q = actions.action_queue(_items(spark, rows)).collect()
    assert [r["customer_id"] for r in q] == [1, 3]
    top = q[0].asDict()
    assert top["issue_type"] == "failed_payment + late_fulfillment + support_escalation"
    # equal values and branch: the smaller reason text comes first
    assert top["reason"] == "1 retry | 5 of 2 days"
    assert top["expected_value"] == 230.0
    assert top["recommended_action"] == "pay"


def test_limit_and_empty_queue(spark):
    rows = [(i, "B", "support_escalation", float(i), "call", "r", 4) for i in range(1, 11)]
    q = actions.action_queue(_items(spark, rows), limit=3).collect()
    assert [r["customer_id"] for r in q] == [10, 9, 8]
    empty = actions.action_queue(_items(spark, []))
    assert empty.count() == 0 and empty.columns == actions.QUEUE_COLUMNS


# customer_id, brand, issue_type, expected_value, action, reason, branch
HAND_ITEMS = [
    (1, "A", "failed_payment", 10.0, "p1", "x", 1),
    (1, "A", "failed_payment", 10.0, "p1", "x", 1),      # repeated row: value counts twice
    (1, "A", "failed_payment", 30.0, "p2", "x", 1),      # same reason, higher value, other action
    (1, "B", "late_fulfillment", 40.0, "l", "y", 2),     # same customer under another brand
    (2, "A", "late_fulfillment", None, "l", "z", 2),     # value unknown: last of its customer
    (2, "A", "support_escalation", 0.0, "s", "w", 4),
    (3, "A", "support_escalation", 50.0, "s", "v", 4),
    (3, "A", "discount_margin_leak", 50.0, "d", "u", 3),  # tie with the row above: lower branch first
    (None, "A", "failed_payment", 70.0, "p", "t", 1),    # no customer: not queued
]
HAND_QUEUE = [
    (3, "A", "discount_margin_leak + support_escalation", 100.0, "d", "u | v"),
    (1, "A", "failed_payment", 50.0, "l", "x"),           # the action of the customer's best item, across brands
    (1, "B", "late_fulfillment", 40.0, "l", "y"),
    (2, "A", "support_escalation + late_fulfillment", 0.0, "s", "w | z"),
]


@pytest.mark.parametrize("limit", [None, 75, 4, 2, 1])
def test_queue_equals_hand_written_rows_in_order(spark, limit):
    got = [tuple(r) for r in actions.action_queue(_items(spark, HAND_ITEMS), limit).collect()]
    assert got == (HAND_QUEUE[:limit] if limit else HAND_QUEUE)


def test_limit_is_a_prefix_of_the_full_queue(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(400):
        cid, issue = int(rng.integers(1, 60)), ISSUES[int(rng.integers(0, 4))]
        rows.append((cid, f"B{cid % 3}", issue, float(rng.choice([5.0, 10.0, 12.5])), f"act {k % 3}",
                     f"reason {k % 6}", actions.BRANCH_ORDER[issue]))
    items = _items(spark, rows)
    full = [tuple(r) for r in actions.action_queue(items, None).collect()]
    assert abs(sum(r[3] for r in full) - sum(r[3] for r in rows)) < 1e-6
    assert [tuple(r) for r in actions.action_queue(items, 20).collect()] == full[:20]


def test_items_are_reduced_by_a_hash_aggregate(spark):
    plan = actions.reduce_items(_items(spark, HAND_ITEMS))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
