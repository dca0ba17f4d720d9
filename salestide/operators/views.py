"""Dashboard-shaped views over the KPI tables (v01-v05).

The original dashboard did this shaping in pandas on the driver; here each
view is a lazy DataFrame over a KPI table.  Shares divide by a total taken as
a scalar subquery (a global partial/final aggregate), never by a window over
one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.functions.money import ratio
from salestide.functions.timefns import weekday_name


def labelled(df: DataFrame, label: str, value: str) -> DataFrame:
    """Rename to (label, revenue) and drop rows with a NULL in either."""
    return (df.select(F.col(label).alias("label"), F.col(value).alias("revenue"))
            .na.drop(subset=["label", "revenue"]))


def with_share(df: DataFrame, value: str = "revenue", name: str = "percent") -> DataFrame:
    """Add ``value / Σ value`` (the sum is exact over 2-dp money)."""
    total = df.agg(F.sum(F.col(value).cast("decimal(38,2)")).cast("double").alias("t")).scalar()
    return df.withColumn(name, ratio(F.col(value), total))


def category_share(category_table: DataFrame) -> DataFrame:
    """v01: (label, revenue, percent) from t08."""
    return with_share(labelled(category_table, "category", "revenue_generated"))


def location_share(regional_table: DataFrame) -> DataFrame:
    """v02: revenue shares among the top locations of t02 (not of all)."""
    return with_share(labelled(regional_table, "location", "total_revenue"))


def weekday_named(weekday_table: DataFrame) -> DataFrame:
    """v03: t05 without its NULL group, with a Sun…Sat label."""
    clean = weekday_table.na.drop(subset=["order_weekday", "weekday_sales"])
    return clean.select("order_weekday", weekday_name("order_weekday").alias("weekday"),
                        "weekday_sales")


def membership_clean(membership_table: DataFrame) -> DataFrame:
    """v04: t03 as (label, revenue) without NULLs."""
    return labelled(membership_table, "membership_type", "revenue_generated")


def trend_clean(trend_table: DataFrame) -> DataFrame:
    """v05: a t04/t05/t06 table with NULL groups dropped and types fixed
    (int key, double value)."""
    key, value = trend_table.columns[:2]
    return (trend_table.na.drop(subset=[key, value])
            .select(F.col(key).cast("int").alias(key), F.col(value).cast("double").alias(value))
            .orderBy(key))
