"""Scalar KPIs (k01-k12) and the one-row KPI summary (k13).

Each function returns a one-row DataFrame with one column named as in the
summary relation.  Ratios are computed in double from exact decimal sums and
return NULL (not an error) on an empty denominator.  One ``as_of`` instant is
used by every time-window KPI.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.functions.money import as_double, growth_pct, ratio
from salestide.functions.timefns import as_of_column, interval
from salestide.operators.tables import customer_revenue, product_sales
from salestide.schemas import SUMMARY


def total_orders(orders: DataFrame) -> DataFrame:
    """k01: number of order rows."""
    return orders.agg(F.count(F.lit(1)).alias("total_orders_count"))


def new_customers(customers: DataFrame, as_of=None, lookback: str = "3 hours",
                  distinct: bool = True) -> DataFrame:
    """k02: customers who signed up at or after ``as_of - lookback`` (no upper
    bound).  ``distinct`` counts a customer id once even when the ingest
    delivered it twice."""
    since = as_of_column(as_of) - interval(lookback)
    recent = customers.filter(F.col("signup_date") >= since)
    n = F.count_distinct("customer_id") if distinct else F.count(F.lit(1))
    return recent.agg(n.alias("customers_in_last_3hrs"))


def total_sales(orders: DataFrame) -> DataFrame:
    """k03: sum of order totals."""
    return orders.agg(as_double(F.sum("total_amount")).alias("total_sales_amount"))


def items_sold(items: DataFrame, per_product: DataFrame | None = None) -> DataFrame:
    """k04: sum of item quantities (or of ``product_sales`` units)."""
    if per_product is not None:
        return per_product.agg(F.sum("units").cast("bigint").alias("total_items_sold"))
    return items.agg(F.sum("quantity").cast("bigint").alias("total_items_sold"))


def unique_products(items: DataFrame, approx: bool = False,
                    per_product: DataFrame | None = None) -> DataFrame:
    """k05: distinct product ids sold (``approx`` trades exactness for a
    fixed-size HyperLogLog sketch; with ``per_product`` the ids are already
    distinct and are simply counted)."""
    if per_product is not None:
        return per_product.agg(F.count("product_id").alias("total_products_sold"))
    n = F.approx_count_distinct("product_id") if approx else F.count_distinct("product_id")
    return items.agg(n.alias("total_products_sold"))


def average_order_value(orders: DataFrame) -> DataFrame:
    """k06: total sales / number of order rows."""
    return orders.agg(ratio(F.sum("total_amount"), F.count(F.lit(1))).alias("aov"))


def acquisition_cost(customers: DataFrame, total_cost: float = 50000) -> DataFrame:
    """k07: ``total_cost`` divided by all customer rows; 0 when there are none."""
    n = F.count(F.lit(1))
    return customers.agg(
        F.when(n > 0, ratio(F.lit(float(total_cost)), n)).otherwise(F.lit(0.0)).alias("cac"))


def conversion_delay(customers: DataFrame, orders: DataFrame,
                     per_customer: DataFrame | None = None) -> DataFrame:
    """Per customer: hours from signup to first order, from whole seconds,
    rounded half-up to 2 dp (negative when the first order precedes signup).
    Columns: customer_id, name, cust_activation_date, first_purchase_date,
    interval_for_first_order_hour.  ``per_customer`` is an already computed
    ``customer_revenue(orders)``."""
    if per_customer is not None:
        first = per_customer.select("customer_id",
                                    F.col("first_order").alias("first_purchase_date"))
    else:
        first = orders.groupBy("customer_id").agg(
            F.min("order_date").alias("first_purchase_date"))
    joined = customers.select(
        "customer_id", "name", F.col("signup_date").alias("cust_activation_date")
    ).join(first, "customer_id")
    seconds = (F.unix_timestamp("first_purchase_date")
               - F.unix_timestamp("cust_activation_date"))
    hours = F.round(seconds.cast("decimal(20,0)") / F.lit(3600), 2)
    return joined.withColumn("interval_for_first_order_hour", hours)


def avg_conversion_delay(customers: DataFrame, orders: DataFrame,
                         per_customer: DataFrame | None = None) -> DataFrame:
    """k08: mean of the per-customer delays (labelled "conversion rate" in the
    original, but it is a mean delay in hours)."""
    h = F.col("interval_for_first_order_hour")
    return conversion_delay(customers, orders, per_customer).agg(
        ratio(F.sum(h), F.count(h)).alias("avg_time"))


def retention_pct(orders: DataFrame, min_orders: int = 2,
                  per_customer: DataFrame | None = None) -> DataFrame:
    """k09: percent of ordering customers with at least ``min_orders`` orders
    (all time).  ``per_customer`` is an already computed
    ``customer_revenue(orders)``."""
    per = per_customer if per_customer is not None else customer_revenue(orders)
    repeat = F.sum(F.when(F.col("orders") >= min_orders, 1).otherwise(0))
    return per.agg((ratio(repeat, F.count(F.lit(1))) * 100).alias("percent_repeat_customers"))


def sales_window(orders: DataFrame, as_of=None, lookback: str = "3 hours") -> DataFrame:
    """k10: sales at or after ``as_of - lookback``; 0 when there are none."""
    since = as_of_column(as_of) - interval(lookback)
    recent = orders.filter(F.col("order_date") >= since)
    return recent.agg(
        as_double(F.coalesce(F.sum("total_amount"), F.lit(Decimal("0")))).alias("sales_in_last3hrs"))


def period_sums(orders: DataFrame, as_of=None, period: str = "3 hours") -> DataFrame:
    """One row (cur, prev): sales in ``[as_of-period, ∞)`` and in
    ``[as_of-2·period, as_of-period)``, from one scan whose earliest bound
    is pushed to the source."""
    a = as_of_column(as_of)
    p = interval(period)
    start_cur, start_prev = a - p, a - p - p
    ts, amt = F.col("order_date"), F.col("total_amount")
    zero = F.lit(Decimal("0"))
    return orders.filter(ts >= start_prev).agg(
        F.coalesce(F.sum(F.when(ts >= start_cur, amt)), zero).alias("cur"),
        F.coalesce(F.sum(F.when(ts < start_cur, amt)), zero).alias("prev"))


def growth_rate(orders: DataFrame, as_of=None, period: str = "3 hours") -> DataFrame:
    """k11: percent change of sales in ``[as_of-period, ∞)`` over
    ``[as_of-2·period, as_of-period)``; +Infinity when the previous period is
    0 and the current one positive, 0 when both are 0.  One scan: the two
    periods are conditional sums (``period_sums``)."""
    both = period_sums(orders, as_of, period)
    return both.select(growth_pct(F.col("cur"), F.col("prev")).alias("growth_rate"))


def inventory_turnover(items: DataFrame, products: DataFrame,
                       cost_ratio: float = 0.7,
                       per_product: DataFrame | None = None) -> DataFrame:
    """k12: COGS / (units sold / 2), COGS = Σ quantity · cost_ratio · list
    price (items left-joined to products, so unmatched items add units but
    no cost).  A 0 or missing unit total counts as 1."""
    per_product = per_product if per_product is not None else product_sales(items)
    joined = per_product.select("product_id", F.col("units").alias("q")).join(
        products.select("product_id", "price"), "product_id", "left")
    unit_cost = F.col("price") * F.lit(Decimal(str(cost_ratio)))
    agg = joined.agg(F.sum(F.col("q") * unit_cost).alias("cogs"), F.sum("q").alias("units"))
    cogs = F.coalesce(as_double(F.col("cogs")), F.lit(0.0))
    units = F.when(F.coalesce(F.col("units"), F.lit(0)) == 0, F.lit(1)).otherwise(F.col("units"))
    return agg.select(F.try_divide(cogs, as_double(units) / 2.0).alias("inventory_turnover"))


def _row(df: DataFrame):
    """A one-row frame as a struct-valued scalar subquery (equal ones run once)."""
    return df.select(F.struct(*df.columns)).scalar()


def _window_kpis(orders: DataFrame, as_of, lookback: str, period: str) -> list[DataFrame]:
    """k10 and k11.  With equal lookback and period (the original's 3 hours)
    both come from one ``period_sums`` aggregate, which the merged scalar
    subqueries then read in a single scan."""
    if lookback != period:
        return [sales_window(orders, as_of, lookback), growth_rate(orders, as_of, period)]
    both = period_sums(orders, as_of, period)
    return [both.select(as_double(F.col("cur")).alias("sales_in_last3hrs")),
            both.select(growth_pct(F.col("cur"), F.col("prev")).alias("growth_rate"))]


def kpi_summary(customers: DataFrame, products: DataFrame, orders: DataFrame,
                items: DataFrame, as_of=None, lookback: str = "3 hours",
                period: str = "3 hours", total_cost: float = 50000,
                cost_ratio: float = 0.7, new_customer_rows: DataFrame | None = None,
                recent_orders: DataFrame | None = None,
                signups: DataFrame | None = None,
                first_orders: DataFrame | None = None,
                per_customer: DataFrame | None = None,
                per_product: DataFrame | None = None) -> DataFrame:
    """k13: the twelve KPIs as one row, in the fixed column order.

    Everything about orders and items comes from two aggregates, per customer
    and per product, so each fact table is scanned once for them.  The row is
    built from scalar subqueries over one-row frames (equal subqueries run
    once): one job instead of one action per KPI.  Optional frames let a caller feed
    the time-window KPIs from a finer-grained source (``recent_orders``,
    ``new_customer_rows``) or the conversion delay from other signup/order
    sources; by default everything comes from the four relations.  With
    ``as_of=None`` Spark fixes "now" once per query, subqueries included, so
    every KPI of the row uses the same instant.
    """
    recent_orders = orders if recent_orders is None else recent_orders
    new_customer_rows = customers if new_customer_rows is None else new_customer_rows
    signups = customers if signups is None else signups
    # the shared per-customer aggregate holds first orders of ``orders`` only
    per_customer = per_customer if per_customer is not None else customer_revenue(orders)
    delay_pre = per_customer if first_orders is None else None
    first_orders = orders if first_orders is None else first_orders
    by_customer = per_customer.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.sum("revenue").alias("revenue"),
        F.sum(F.when(F.col("orders") >= 2, 1).otherwise(0)).alias("repeat"),
        F.count(F.lit(1)).alias("customers"))
    per_product = per_product if per_product is not None else product_sales(items)
    by_product = per_product.agg(F.sum("units").cast("bigint").alias("units"),
                                 F.count("product_id").alias("ids"))
    c, p = _row(by_customer), _row(by_product)
    one = {
        "total_orders_count": c["rows"],
        "total_sales_amount": as_double(c["revenue"]),
        "total_items_sold": p["units"],
        "total_products_sold": p["ids"],
        "aov": ratio(c["revenue"], c["rows"]),
        "percent_repeat_customers": ratio(c["repeat"], c["customers"]) * 100,
    }
    for df in (new_customers(new_customer_rows, as_of, lookback), acquisition_cost(customers, total_cost),
               avg_conversion_delay(signups, first_orders, per_customer=delay_pre),
               inventory_turnover(items, products, cost_ratio, per_product=per_product),
               *_window_kpis(recent_orders, as_of, lookback, period)):
        one[df.columns[0]] = df.scalar()
    return customers.sparkSession.range(1).select(
        *[one[f.name].alias(f.name) for f in SUMMARY.fields])
