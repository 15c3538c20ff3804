"""Reports of different run days, compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_changes(before: DataFrame, after: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key of either day: ``change`` (new, gone, changed, same) and,
    for each value, both days' values and their difference (NULL where a day
    has none).  Keys match NULL with NULL; a key must be unique in its day."""
    a = before.select(*[F.col(k).alias(f"a_{k}") for k in keys], *[F.col(v).alias(f"{v}_before") for v in values], F.lit(True).alias("in_a"))
    b = after.select(*[F.col(k).alias(f"b_{k}") for k in keys], *[F.col(v).alias(f"{v}_after") for v in values], F.lit(True).alias("in_b"))
    both = a.join(b, reduce(lambda x, y: x & y, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys]), "full")
    same = reduce(lambda x, y: x & y, [F.col(f"{v}_before").eqNullSafe(F.col(f"{v}_after")) for v in values])
    change = F.when(F.col("in_a").isNull(), "new").when(F.col("in_b").isNull(), "gone").when(same, "same").otherwise("changed")
    return both.select(
        *[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys],
        change.alias("change"),
        *[c for v in values for c in (F.col(f"{v}_before"), F.col(f"{v}_after"), (F.col(f"{v}_after") - F.col(f"{v}_before")).alias(f"{v}_delta"))],
    )
