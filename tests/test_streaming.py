"""The streaming alerts end in the same state as the batch operators over
the same events (events are the adapter's output, written in two parts)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from reclaim.operators import monitoring
from reclaim.streaming import monitor
from reclaim.sources import tpch

from conftest import SF_SMALL, rows

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="warehouse fixture not available")


def _write_in_two_parts(df, folder, key):
    df.where(F.pmod(F.col(key), F.lit(2)) == 0).write.mode("overwrite").parquet(f"{folder}/part=0")
    df.where(F.pmod(F.col(key), F.lit(2)) == 1).write.mode("overwrite").parquet(f"{folder}/part=1")


def _alert_rows(df):
    cols = ["severity", "entity", "current_value", "impact_value"]
    return sorted(rows(df, *cols))


def test_fulfillment_stream_matches_batch(spark):
    inputs = tpch.load(spark, SF_SMALL)
    events = inputs["fulfillment_events"]
    base = tempfile.mkdtemp(prefix="reclaim-stream-")
    src, out = f"{base}/events", f"{base}/totals"
    _write_in_two_parts(events, src, "order_id")
    q = monitor.fulfillment_totals_stream(spark, f"{src}/*", events.schema, out, checkpoint=f"{base}/state")
    q.awaitTermination(300)
    got = monitor.current_fulfillment_alerts(spark, out)
    assert _alert_rows(got) == _alert_rows(monitoring.fulfillment_alerts(events))


def test_payment_stream_matches_batch(spark):
    inputs = tpch.load(spark, SF_SMALL)
    events, customers = inputs["payment_events"], inputs["customers"]
    base = tempfile.mkdtemp(prefix="reclaim-stream-")
    src, out = f"{base}/events", f"{base}/totals"
    _write_in_two_parts(events, src, "invoice_id")
    q = monitor.payment_totals_stream(spark, f"{src}/*", events.schema, customers, out, checkpoint=f"{base}/state")
    q.awaitTermination(300)
    got = monitor.current_payment_alerts(spark, out)
    assert _alert_rows(got) == _alert_rows(monitoring.payment_alerts(customers, events))


def test_retried_batch_and_compaction_keep_the_totals(spark):
    out = tempfile.mkdtemp(prefix="reclaim-totals-")
    schema = "brand string, orders long, late_orders long"
    spark.createDataFrame([("A", 10, 1), ("B", 5, 5)], schema).write.parquet(f"{out}/batch_id=0")
    for _ in range(2):  # the same batch, run again after a failure
        spark.createDataFrame([("A", 20, 9)], schema).write.mode("overwrite").parquet(f"{out}/batch_id=1")
    want = [("A", 20, 9), ("B", 5, 5)]
    assert sorted(rows(monitor.latest_totals(spark, out), "brand", "orders", "late_orders")) == want
    monitor.compact(spark, out)
    assert sorted(rows(monitor.latest_totals(spark, out), "brand", "orders", "late_orders")) == want
    assert len([d for d in os.listdir(out) if d.startswith("batch_id=")]) == 1
