"""Exact money arithmetic: decimal inside aggregations, double at the edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.schemas import MONEY


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c: str | Column) -> Column:
    """Cast to ``decimal(18,2)`` (HALF_UP from the value's shortest form)."""
    return _col(c).cast(MONEY)


def as_double(c: str | Column) -> Column:
    return _col(c).cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` in double precision; NULL instead of an error on 0."""
    return F.try_divide(as_double(num), as_double(den))


def growth_pct(cur: Column, prev: Column) -> Column:
    """Percent change of ``cur`` over ``prev``: NULL without a previous
    value, +Infinity when the previous value is 0 and the current one
    positive, 0 when both are 0."""
    return (F.when(prev.isNull(), F.lit(None).cast("double"))
            .when(prev == 0, F.when(cur > 0, F.lit(float("inf"))).otherwise(F.lit(0.0)))
            .otherwise(ratio(cur - prev, prev) * 100))


def line_amount(items: DataFrame) -> Column:
    """Revenue of one order line: the carried exact amount when the source
    has one, else ``quantity * unit_price``."""
    if "line_amount" in items.columns:
        return F.col("line_amount")
    return F.col("quantity") * F.col("unit_price")
