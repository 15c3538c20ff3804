"""Ranks over any number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def global_rank(df: DataFrame, order: list[Column], name: str = "rank", write=materialize) -> DataFrame:
    """1-based position of every row in ``order`` without moving all rows
    into one partition.

    Rows are range-partitioned and sorted on the key (a distributed sort);
    each row's position inside its partition comes from
    ``monotonically_increasing_id`` (partition index in the high bits, row
    index in the low 33 bits).  The tagged rows are written once as a table
    under the session's checkpoint folder, which fixes the ids (and cuts the
    lineage), so partition sizes - one row per partition - give consistent
    offsets.  ``order`` must be a total order (unique tie-breakers) so the
    result is deterministic.  ``write(df, name)`` writes that table.
    """
    tagged = write(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "ranked")
    tagged = tagged.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: bounded by the partition count.
    offsets = sizes.withColumn(
        "_offset",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select("_part", "_offset")
    out = tagged.join(F.broadcast(offsets), "_part")
    return out.withColumn(name, F.col("_offset") + F.col("_local") + 1).drop("_mid", "_part", "_local", "_offset")
