"""Streaming payment and fulfillment alerts.

Events arrive as files in a folder.  The per-brand totals are streaming
aggregation state (kept in the query's checkpoint folder, so a restarted
driver resumes where it stopped).  Every micro-batch writes the totals it
changed to a folder of its own, which a retried batch overwrites; ``compact``
folds the folders into one.  The current alerts are the alert rule applied to the
latest totals of each brand, so a brand that recovers drops out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import monitoring
from ..session import delete_tables, ensure_checkpoint_dir, materialize


def _state_dir(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def _start(totals: DataFrame, name: str, totals_dir: str, checkpoint: str | None, available_now: bool):
    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{totals_dir}/batch_id={batch_id}")

    writer = (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", _state_dir(totals.sparkSession, name, checkpoint))
        .foreachBatch(replace)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def fulfillment_totals_stream(spark: SparkSession, events_dir: str, schema, totals_dir: str,
                              checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Running per-brand order and late-order counts (state behind H6)."""
    events = spark.readStream.schema(schema).parquet(events_dir)
    return _start(monitoring.fulfillment_rates(events), "fulfillment_totals", totals_dir, checkpoint, available_now)


def payment_totals_stream(spark: SparkSession, events_dir: str, schema, customers: DataFrame, totals_dir: str,
                          checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Running per-brand invoice totals (state behind H5); the customer
    table is the static side of a stream-static join."""
    events = spark.readStream.schema(schema).parquet(events_dir)
    return _start(monitoring.payment_rates(customers, events), "payment_totals", totals_dir, checkpoint,
                  available_now)


def latest_totals(spark: SparkSession, totals_dir: str) -> DataFrame:
    """Each brand's totals as of the last micro-batch that changed them."""
    t = spark.read.parquet(totals_dir)
    last = t.withColumn("_last", F.max("batch_id").over(Window.partitionBy("brand")))
    return last.where(F.col("batch_id") == F.col("_last")).drop("_last", "batch_id")


def compact(spark: SparkSession, totals_dir: str) -> None:
    """Fold all batch folders into the one of the last batch (run between
    batches).  It holds each brand's latest totals, so a reader sees the same
    totals before, meanwhile and after."""
    batches = sorted(r[0] for r in spark.read.parquet(totals_dir).select("batch_id").distinct().collect())  # a row per batch
    if len(batches) > 1:
        latest = materialize(latest_totals(spark, totals_dir), "totals")
        latest.write.mode("overwrite").parquet(f"{totals_dir}/batch_id={batches[-1]}")
        delete_tables(spark, [f"{totals_dir}/batch_id={b}" for b in batches[:-1]])


def current_fulfillment_alerts(spark: SparkSession, totals_dir: str) -> DataFrame:
    return monitoring.fulfillment_alerts_from_rates(latest_totals(spark, totals_dir))


def current_payment_alerts(spark: SparkSession, totals_dir: str) -> DataFrame:
    return monitoring.payment_alerts_from_rates(latest_totals(spark, totals_dir))
