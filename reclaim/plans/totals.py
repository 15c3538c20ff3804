"""One-row totals of tables and reports, collected once.

A table that is written anyway gives its totals on the way
(``DataFrame.observe``): no second scan, no second plan.  Totals of other
frames are one aggregate job.  Both come back as one-row local frames, so a
report made of totals (run KPIs, scorecard, monitoring summary, headline) plans
no scan at all.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

Write = Callable[[DataFrame, str], DataFrame]


def literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType) and value is not None:
        return F.struct(*[literal(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.lit(value).cast(kind)


def one_row(df: DataFrame, values: dict, schema: T.StructType) -> DataFrame:
    """A row of literals: plans made of it fold to constants."""
    return df.sparkSession.sql("SELECT 1 AS one").select(*[literal(values[f.name], f.dataType).alias(f.name) for f in schema.fields])


class Totals:
    def __init__(self, write: Write):
        self._write = write
        self._rows: dict[str, DataFrame] = {}

    def write(self, df: DataFrame, name: str, metrics: list[Column]) -> DataFrame:
        """``df`` as a written table; its metrics are observed by the tasks
        that write it (no DISTINCT aggregates)."""
        if not metrics:
            return self._write(df, name)
        seen = Observation()
        # The types of the metrics, without running anything.
        schema = df.agg(*metrics).schema
        out = self._write(df.observe(seen, *metrics), name)
        self._rows[name] = one_row(df, seen.get, schema)
        return out

    def of(self, df: DataFrame, name: str, metrics: list[Column]) -> DataFrame:
        """Totals of the table ``name``: those observed when it was written,
        else one aggregate over ``df``."""
        if name not in self._rows:
            one = df.agg(*metrics)
            self._rows[name] = one_row(df, one.first().asDict(), one.schema)
        return self._rows[name]

