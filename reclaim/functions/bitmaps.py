"""Exact distinct counts of integer ids by bitmaps that merge.

An id is bit ``bitmap_bit_position`` of bitmap ``bitmap_bucket_number``.  Rows
are dealt by bucket first, so that the bitmaps of a bucket are made where all
its ids are and are as full as the ids allow (made on the map side, they would
be nearly empty, 4 KB each).  From the finest keys upwards counts need no id
again: bitmaps of a bucket are joined with OR and their bits added up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "_bucket", "_bits"


def countable(df: DataFrame, id_column: str) -> bool:
    """Whether the ids are integers (others have no bit positions)."""
    return dict(df.dtypes)[id_column] in ("tinyint", "smallint", "int", "bigint")


def bitmaps(df: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """One bitmap per combination of keys and bucket; NULL ids count nowhere."""
    ids = F.col(id_column).cast("long")
    dealt = df.where(F.col(id_column).isNotNull()).select(*keys, F.bitmap_bucket_number(ids).alias(BUCKET), F.bitmap_bit_position(ids).alias("_bit"))
    return dealt.repartition(BUCKET).groupBy(*keys, BUCKET).agg(F.bitmap_construct_agg("_bit").alias(BITS))


def distinct_ids(made: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number of different ids per combination of some of the keys."""
    merged = made.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))
