"""Column-expression helpers shared by all operators.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen.  The matching DuckDB forms used by the
oracle are noted next to each helper.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c: str | Column, digits: int) -> Column:
    """Round half to even after scaling (numpy's table rounding).

    ``round()`` in Spark is half-up on the decimal text, which disagrees with
    numpy and DuckDB on doubles like 1.005.  DuckDB twin:
    ``round_even(x * 10^d, 0) / 10^d``.
    """
    scale = float(10**digits)
    # "+ 0.0" turns a negative zero into zero.
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def cents(c: str | Column) -> Column:
    """Money as an exact integer count of cents (sums become exact and
    order-independent).  DuckDB: ``CAST(round_even(x * 100, 0) AS BIGINT)``."""
    return F.rint(col(c) * F.lit(100.0)).cast("long")


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero (or NULL) divisor instead of an
    error; the reference turns those into NaN."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def max0(c: str | Column) -> Column:
    """``max(0, x)`` that keeps NULL as NULL (``greatest`` would skip it)."""
    x = col(c)
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), x))


def pct_text(c: str | Column) -> Column:
    """Whole-percent text, e.g. 0.385 -> '38%' (half to even)."""
    return F.concat(F.rint(col(c) * F.lit(100.0)).cast("long").cast("string"), F.lit("%"))


MONEY = "decimal(28,6)"


def exact_sum(c: str | Column) -> Column:
    """Sum of a money-like column (at most 6 decimals) in fixed point, so
    the result does not depend on the order rows arrive in.  Empty -> 0.
    Values up to 1e22, sums up to 1e32.
    DuckDB: ``CAST(sum(CAST(x AS DECIMAL(28,6))) AS DOUBLE)``."""
    return F.coalesce(F.sum(col(c).cast(MONEY)).cast("double"), F.lit(0.0))


def exact_avg(c: str | Column) -> Column:
    """Mean of a fixed-decimal column (rounded scores, money), order-free."""
    return F.sum(col(c).cast(MONEY)).cast("double") / F.count(col(c))


def attach(df, one_row):
    """Attach the columns of a one-row aggregate to every row of ``df`` as
    scalar subqueries: the aggregate runs once (Spark merges the per-column
    subqueries into one) and its values reach the tasks as literals, with
    no join in the plan.  ``one_row`` must be a global ``agg`` (one row).
    """
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])


def latest_per(df, key: str, order: str, **values: Column):
    """One row per key: its largest ``order`` and the values of that row.  With
    numeric values all buffers are fixed-width, so this is a hash aggregate
    with map-side partial results, not a window over all rows of a key.  Rows
    with a NULL order come last; filter ``df`` for a point in time."""
    latest = [F.max_by(value, F.col(order)).alias(name) for name, value in values.items()]
    return df.groupBy(key).agg(F.max(order).alias(order), *latest)


PRECISE = "decimal(38,12)"


def precise_sum(c: str | Column) -> Column:
    """Order-independent sum of an arbitrary double: each value is taken
    at 12 decimals and added exactly.  Empty -> 0.
    DuckDB: ``CAST(sum(CAST(x AS DECIMAL(38,12))) AS DOUBLE)``."""
    return F.coalesce(F.sum(col(c).cast(PRECISE)).cast("double"), F.lit(0.0))


def precise_avg(c: str | Column) -> Column:
    """Order-independent mean of an arbitrary double (see precise_sum)."""
    return F.sum(col(c).cast(PRECISE)).cast("double") / F.count(col(c))


def lazy(df, name: str, metrics: list[Column]):
    """One-row totals as a plan (see ``plans.totals`` for collected ones)."""
    return df.agg(*metrics)
