"""Extensions: KPIs the original requirements name but never computed
(d01-d12).  Definitions are ours and documented per function."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.functions.money import as_double, growth_pct, line_amount, ratio
from salestide.functions.timefns import as_of_column, interval, interval_seconds
from salestide.operators.tables import customer_revenue, top_named


def customer_distribution(customers: DataFrame, by: str = "gender") -> DataFrame:
    """d01: distinct customers per value of ``by`` and their percent of all
    distinct customers.  Columns: <by>, customer_count, percent."""
    total = customers.agg(F.count_distinct("customer_id").alias("n")).scalar()
    counts = customers.groupBy(by).agg(F.count_distinct("customer_id").alias("customer_count"))
    return counts.withColumn("percent", ratio(F.col("customer_count"), total) * 100)


def total_customers(customers: DataFrame) -> DataFrame:
    """d02: distinct customer ids."""
    return customers.agg(F.count_distinct("customer_id").alias("total_customers"))


def total_products(products: DataFrame) -> DataFrame:
    """d03: distinct product ids in the catalogue."""
    return products.agg(F.count_distinct("product_id").alias("total_products"))


def top_selling_products(items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """d04: top k products by units sold, named.
    Columns: product_id, name, units_sold."""
    units = items.groupBy("product_id").agg(F.sum("quantity").cast("bigint").alias("units_sold"))
    return top_named(units, products, "units_sold", k).select("product_id", "name", "units_sold")


def sales_per_customer(orders: DataFrame) -> DataFrame:
    """d05: per customer: orders, sales and average order value.
    Columns: customer_id, order_count, total_sales, avg_order_value."""
    per = customer_revenue(orders)
    return per.select(
        "customer_id", F.col("orders").alias("order_count"),
        as_double(F.col("revenue")).alias("total_sales"),
        ratio(F.col("revenue"), F.col("orders")).alias("avg_order_value"))


def conversion_rate(leads: DataFrame, sales: DataFrame, key: str = "customer_id") -> DataFrame:
    """d06: percent of distinct leads (visitors, signups) with at least one
    sale.  Both sides are reduced to distinct keys before the join.
    Columns: leads, converted, conversion_rate_pct."""
    lead_ids = leads.select(key).where(F.col(key).isNotNull()).distinct()
    buyer_ids = sales.select(key).where(F.col(key).isNotNull()).distinct() \
        .withColumn("_bought", F.lit(1))
    joined = lead_ids.join(buyer_ids, key, "left")
    return joined.agg(
        F.count(F.lit(1)).alias("leads"),
        F.count("_bought").alias("converted"),
    ).withColumn("conversion_rate_pct", ratio(F.col("converted"), F.col("leads")) * 100)


def repeat_within_period(orders: DataFrame, period: str = "30 days") -> DataFrame:
    """Customers flagged when two of their orders are at most ``period``
    apart.  Columns: customer_id, repeat (boolean).

    Orders are bucketed into epoch-aligned windows of length ``period``: two
    orders in one bucket are less than ``period`` apart, and across buckets
    only the last order of bucket b and the first of bucket b+1 can be that
    close.  Each (customer, bucket) summary is therefore emitted twice — as
    itself and, carrying its first order, as "next" of the bucket before —
    and one regroup on (customer, bucket) pairs each bucket with its
    successor.  No per-customer sort and no join: a customer holding a third
    of all orders is spread over its buckets, and partial aggregation
    collapses it map-side.
    """
    interval_seconds(period)  # a fixed length: windows have no calendar months
    span = interval(period)
    b = (orders.where(F.col("order_date").isNotNull())
         .groupBy("customer_id", F.window("order_date", period)["start"].alias("bucket"))
         .agg(F.count(F.lit(1)).alias("n"), F.min("order_date").alias("first_ts"),
              F.max("order_date").alias("last_ts")))
    null_ts = F.lit(None).cast("timestamp_ntz")
    both = b.select("customer_id", F.explode(F.array(
        F.struct(F.col("bucket").alias("k"), F.col("n"), F.col("last_ts"),
                 null_ts.alias("next_first_ts")),
        F.struct((F.col("bucket") - span).alias("k"), F.lit(0).cast("bigint").alias("n"),
                 null_ts.alias("last_ts"), F.col("first_ts").alias("next_first_ts")),
    )).alias("e")).select("customer_id", "e.*")
    paired = both.groupBy("customer_id", "k").agg(
        F.sum("n").alias("n"), F.max("last_ts").alias("last_ts"),
        F.min("next_first_ts").alias("next_first_ts"))
    hit = (F.col("n") >= 2) | (F.col("next_first_ts") <= F.col("last_ts") + span)
    return paired.groupBy("customer_id").agg(
        F.max(F.coalesce(hit, F.lit(False))).alias("repeat"))


def retention_in_period(orders: DataFrame, period: str = "30 days") -> DataFrame:
    """d07: percent of ordering customers with a repeat purchase within
    ``period``.  Columns: customers, repeat_customers, retention_pct."""
    flags = repeat_within_period(orders, period)
    return flags.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count(F.when(F.col("repeat"), 1)).alias("repeat_customers"),
    ).withColumn("retention_pct", ratio(F.col("repeat_customers"), F.col("customers")) * 100)


def gross_margin(items: DataFrame, products: DataFrame, cost_ratio: float = 0.7) -> DataFrame:
    """d08: (revenue − COGS) / revenue in percent, COGS = quantity ·
    cost_ratio · list price.  Columns: revenue, cogs, gross_margin_pct."""
    per = items.groupBy("product_id").agg(
        F.sum(line_amount(items)).alias("rev"), F.sum("quantity").alias("q"))
    joined = per.join(products.select("product_id", "price"), "product_id", "left")
    agg = joined.agg(
        F.sum("rev").alias("rev"),
        F.sum(F.col("q") * (F.col("price") * F.lit(Decimal(str(cost_ratio))))).alias("cogs"))
    return agg.select(
        as_double(F.col("rev")).alias("revenue"),
        as_double(F.col("cogs")).alias("cogs"),
        (ratio(F.col("rev") - F.coalesce(F.col("cogs"), F.lit(Decimal("0"))), F.col("rev"))
         * 100).alias("gross_margin_pct"))


def cac_new_only(customers: DataFrame, as_of=None, lookback: str = "3 hours",
                 total_cost: float = 50000) -> DataFrame:
    """d09: ``total_cost`` per customer who signed up since
    ``as_of - lookback`` (0 when there is none).  Column: cac_new."""
    since = as_of_column(as_of) - interval(lookback)
    n = F.count_distinct("customer_id")
    return (customers.filter(F.col("signup_date") >= since)
            .agg(F.when(n > 0, ratio(F.lit(float(total_cost)), n))
                 .otherwise(F.lit(0.0)).alias("cac_new")))


_PERIOD_STEP = {"hour": "1 hour", "day": "1 day", "week": "7 days", "month": "1 month",
                "quarter": "3 months", "year": "1 year"}


def period_start(ts: str, unit: str):
    """Start of the calendar period containing ``ts`` (TIMESTAMP_NTZ, no
    time-zone arithmetic)."""
    c = F.col(ts)
    if unit == "hour":
        return F.window(c, "1 hour")["start"]
    if unit == "day":
        return F.to_date(c).cast("timestamp_ntz")
    if unit in ("week", "month", "quarter", "year"):
        return F.trunc(F.to_date(c), unit).cast("timestamp_ntz")
    raise ValueError(f"unit must be one of {sorted(_PERIOD_STEP)}")


def with_previous(per: DataFrame, key: str, step, value: str) -> DataFrame:
    """Pair each row of a per-period aggregate with the row whose ``key`` is
    one ``step`` earlier: every row is emitted as itself and, shifted by
    ``step``, as the previous value of its successor; one regroup on
    ``key`` matches them.  Adds ``prev_<value>`` (NULL when the previous
    period has no row).  Rows with a NULL value stay; a NULL key has no
    neighbours."""
    null = F.lit(None).cast(per.schema[value].dataType)
    both = per.select(F.explode(F.array(
        F.struct(F.col(key).alias("k"), F.col(value).alias("cur"), null.alias("prev"),
                 F.lit(True).alias("here")),
        F.struct((F.col(key) + step).alias("k"), null.alias("cur"), F.col(value).alias("prev"),
                 F.lit(False).alias("here")),
    )).alias("e")).select("e.*").where(F.col("here") | F.col("k").isNotNull())
    return (both.groupBy("k").agg(F.max("cur").alias(value), F.max("prev").alias("prev_" + value),
                                  F.max("here").alias("here"))
            .where("here").drop("here")
            .withColumnRenamed("k", key))


def growth_by_period(orders: DataFrame, unit: str = "month") -> DataFrame:
    """d10: sales per calendar period and percent change over the previous
    calendar period (NULL when that period had no orders; +Infinity/0 on a
    zero base as in k11).  Columns: period_start, sales, prev_sales,
    growth_pct."""
    step = interval(_PERIOD_STEP[unit])
    per = (orders.groupBy(period_start("order_date", unit).alias("period_start"))
           .agg(F.sum("total_amount").alias("sales")))
    j = with_previous(per, "period_start", step, "sales")
    cur, pv = F.col("sales"), F.col("prev_sales")
    return j.select("period_start", as_double(cur).alias("sales"),
                    as_double(pv).alias("prev_sales"), growth_pct(cur, pv).alias("growth_pct")) \
        .orderBy("period_start")


def year_month_trend(orders: DataFrame) -> DataFrame:
    """d11: sales by calendar year and month (unlike t04, years are kept).
    Columns: order_year, order_month, sales."""
    return (orders.groupBy(F.year("order_date").cast("int").alias("order_year"),
                           F.month("order_date").cast("int").alias("order_month"))
            .agg(as_double(F.sum("total_amount")).alias("sales"))
            .orderBy("order_year", "order_month"))


def sales_by_channel(orders: DataFrame) -> DataFrame:
    """d12: orders and sales by sales channel and payment method.
    Columns: sales_channel, payment_method, order_count, sales."""
    return (orders.groupBy("sales_channel", "payment_method")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 as_double(F.sum("total_amount")).alias("sales"))
            .orderBy(F.col("sales").desc(), "sales_channel", "payment_method"))
