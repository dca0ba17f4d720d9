"""KPI tables (one DataFrame each).

Plan shape shared by all of them: aggregate the fact table on its own key
first (partial aggregation runs map-side, so a key holding a third of all
rows collapses to one row per task before any shuffle), then join the much
smaller aggregate to the dimension, then regroup.  Joining first would
shuffle every fact row by the dimension key and put a hot key in one task.
Every ordering ends in the grouping key so that ``limit``/``row_number`` are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salestide.functions.money import line_amount
from salestide.functions.timefns import as_of_column, interval


def _money_out(c, name: str):
    # Sums are exact decimals; round(…, 2) is kept for parity and is a no-op
    # on 2-dp money.  Double only at the edge.
    return F.round(c, 2).cast("double").alias(name)


def customer_revenue(orders: DataFrame) -> DataFrame:
    """Per customer: revenue, order count, row count, first and last order time (the
    shared pre-aggregate of t02, t03, t09, the repeat rate and the
    conversion delay; unused columns are pruned from each plan)."""
    return orders.groupBy("customer_id").agg(
        F.sum("total_amount").alias("revenue"),
        F.count("order_id").alias("orders"),
        F.count(F.lit(1)).alias("rows"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"))


def window_revenue(orders: DataFrame, window: str = "10 days") -> DataFrame:
    """Revenue per (epoch-aligned tumbling window, customer): the first
    step of t01, kept separately so it can be maintained incrementally.
    Columns: w (window struct), customer_id, ltv."""
    return (orders.groupBy(F.window("order_date", window).alias("w"), "customer_id")
            .agg(F.sum("total_amount").alias("ltv")))


def customer_ltv(orders: DataFrame, customers: DataFrame, window: str = "10 days",
                 k: int = 5, per_window: DataFrame | None = None) -> DataFrame:
    """t01: revenue per customer per tumbling window (epoch-aligned), top k
    customers per window.  Columns: customer_id, name, customer_ltv, rank,
    window_start, window_end.  ``per_window`` is an already computed
    ``window_revenue(orders, window)``."""
    per_window = per_window if per_window is not None else window_revenue(orders, window)
    named = per_window.join(customers.select("customer_id", "name"), "customer_id")
    # A customer id present twice with one name sums twice, as a join-then-group
    # plan would.  Under a sort-merge join (large customer tables) the rows are
    # already clustered by customer, so this regroup adds no shuffle.
    per_customer = named.groupBy("w", "customer_id", "name").agg(F.sum("ltv").alias("ltv"))
    order = Window.partitionBy("w").orderBy(
        F.col("ltv").desc(), F.col("customer_id").asc(), F.col("name").asc())
    # rank <= k right after row_number lets Catalyst insert a map-side
    # WindowGroupLimit: at most k rows per window leave each task.
    ranked = (per_customer.withColumn("rank", F.row_number().over(order))
              .filter(F.col("rank") <= k))
    return (ranked.select(
        "customer_id", "name", _money_out(F.col("ltv"), "customer_ltv"),
        F.col("rank").cast("int").alias("rank"),
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
        .orderBy("window_start", "rank"))


def _revenue_by(orders: DataFrame, customers: DataFrame, attribute: str,
                per_customer: DataFrame | None = None) -> DataFrame:
    per = (per_customer if per_customer is not None else customer_revenue(orders)) \
        .select("customer_id", "revenue")
    joined = per.join(customers.select("customer_id", attribute), "customer_id")
    return joined.groupBy(attribute).agg(F.sum("revenue").alias("revenue"))


def regional_revenue(orders: DataFrame, customers: DataFrame, k: int = 10,
                     per_customer: DataFrame | None = None) -> DataFrame:
    """t02: revenue by customer location, top k.  Columns: location, total_revenue.
    ``per_customer`` is an already computed ``customer_revenue(orders)``."""
    by_location = _revenue_by(orders, customers, "location", per_customer)
    return (by_location
            .orderBy(F.col("revenue").desc_nulls_last(), F.col("location").asc_nulls_last())
            .limit(k)
            .select("location", _money_out(F.col("revenue"), "total_revenue")))


def membership_revenue(orders: DataFrame, customers: DataFrame,
                       per_customer: DataFrame | None = None) -> DataFrame:
    """t03: revenue by membership type, descending.
    Columns: membership_type, revenue_generated."""
    by_type = _revenue_by(orders, customers, "membership_type", per_customer)
    return (by_type
            .select("membership_type", _money_out(F.col("revenue"), "revenue_generated"))
            .orderBy(F.col("revenue_generated").desc_nulls_last(),
                     F.col("membership_type").asc_nulls_last()))


# part -> (date-part function, key column, value column); fixed output names.
_PARTS = {
    "month": (F.month, "order_month", "monthly_sales"),
    "weekday": (F.dayofweek, "order_weekday", "weekday_sales"),
    "hour": (F.hour, "order_hour", "hourly_sales"),
}


def time_parts(orders: DataFrame) -> DataFrame:
    """Sales by (month, weekday, hour): at most 12·7·24 groups, the shared
    pre-aggregate from which t04-t06 are exact re-sums (one scan for all
    three).  Columns: order_month, order_weekday, order_hour, sales."""
    ts = F.col("order_date")
    return orders.groupBy(*[fn(ts).cast("int").alias(key) for fn, key, _v in _PARTS.values()]) \
        .agg(F.sum("total_amount").alias("sales"))


def sales_by(orders: DataFrame, part: str = "month",
             parts: DataFrame | None = None) -> DataFrame:
    """t04/t05/t06: sales by month number (years merged), by weekday
    (1 = Sunday) or by hour of day.  Few groups, so the map-side partial
    aggregate leaves almost nothing to shuffle.  ``parts`` is an already
    computed ``time_parts(orders)`` (decimal sums re-add exactly)."""
    fn, key, value = _PARTS[part]
    if parts is not None:
        grouped = parts.groupBy(key).agg(F.sum("sales").cast("double").alias(value))
    else:
        grouped = (orders.groupBy(fn("order_date").cast("int").alias(key))
                   .agg(F.sum("total_amount").cast("double").alias(value)))
    return grouped.orderBy(F.col(key).asc_nulls_first())


def top_products(orders: DataFrame, items: DataFrame, products: DataFrame, as_of=None,
                 lookback: str = "15 minutes", k: int = 10,
                 measure: str = "lines") -> DataFrame:
    """t07: products in orders placed since ``as_of - lookback``; top k by
    number of order lines (``measure="lines"``, the original meaning of
    ``count(quantity)``) or by units (``measure="units"``).
    Columns: name, sold_quantity."""
    since = as_of_column(as_of) - interval(lookback)
    recent = orders.filter(F.col("order_date") >= since).select("order_id")
    # The time filter is pushed into the orders scan; Spark's runtime filter
    # then prunes the items side of this join before its shuffle.
    lines = items.join(recent, "order_id")
    if measure == "lines":
        sold = F.count("quantity")
    elif measure == "units":
        sold = F.sum("quantity").cast("bigint")
    else:
        raise ValueError("measure must be 'lines' or 'units'")
    per_product = lines.groupBy("product_id").agg(sold.alias("sold_quantity"))
    return top_named(per_product, products, "sold_quantity", k).select("name", "sold_quantity")


TRACKED = 4096     # products that a sketch follows


def product_sketch(lines: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One mergeable frequent-items sketch of the products of ``lines``, and
    their number: (sketch, n).  A sketch of a part (a task, a pane, a day) is
    a few KB however many products it has seen; ``merge_sketches`` adds them."""
    return lines.agg(F.expr(f"approx_top_k_accumulate(product_id, {tracked})").alias("sketch"),
                     F.count("product_id").alias("n"))


def merge_sketches(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    return sketches.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))


def top_from_sketch(lines: DataFrame, sketch: DataFrame, products: DataFrame, k: int = 10,
                    tracked: int = TRACKED) -> DataFrame:
    """t07 over ``lines`` (product_id, quantity) of any number of products:
    the products that a merged ``sketch`` of these lines follows are counted
    exactly, so ``tracked`` counters a task are shuffled and not one for each
    product.  A product that the sketch has lost has at most
    3.5 / tracked * n lines; where the k-th exact count doesn't exceed that,
    all products are counted instead.  The sketch counts lines, so ``lines``
    are ranked by their number."""
    row = sketch.first()
    n = (row.n if row else 0) or 0
    if not n:
        return top_named(lines.groupBy("product_id").agg(F.count("quantity").alias("sold_quantity")),
                         products, "sold_quantity", k).select("name", "sold_quantity")
    followed = sketch.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {tracked})")).alias("x")).select(
        F.col("x.item").alias("product_id"))
    kept = lines.join(F.broadcast(followed), "product_id")      # ``tracked`` rows at most
    exact = kept.groupBy("product_id").agg(F.count("quantity").alias("sold_quantity"))
    best = exact.orderBy(F.desc("sold_quantity")).limit(k).collect()
    if len(best) < k or best[-1].sold_quantity <= 3.5 / tracked * n:
        exact = lines.groupBy("product_id").agg(F.count("quantity").alias("sold_quantity"))
    return top_named(exact, products, "sold_quantity", k).select("name", "sold_quantity")


def top_named(per_product: DataFrame, products: DataFrame, value: str, k: int) -> DataFrame:
    """Top k rows of a per-product aggregate by ``value`` (ties by id), with
    product names.  The top k ids are taken first and their names looked up
    by streaming the product dimension against those k ids (a broadcast of
    at most k rows), so the dimension is never shuffled; a missing product
    gives a NULL name.  Columns: the aggregate's columns plus name."""
    top = per_product.orderBy(F.col(value).desc(), F.col("product_id")).limit(k)
    names = (products.select("product_id", "name")
             .join(F.broadcast(top.select("product_id")), "product_id"))
    return (top.join(names, "product_id", "left")
            .orderBy(F.col(value).desc(), F.col("product_id"), F.col("name").asc_nulls_first())
            .limit(k))


def product_sales(items: DataFrame) -> DataFrame:
    """Units and line revenue per product id: the pre-aggregate of the
    order items shared by k04, k05, k12 and t08 (one scan of the largest
    table for all four).  Columns: product_id, units, revenue."""
    return items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), F.sum(line_amount(items)).alias("revenue"))


def category_revenue(items: DataFrame, products: DataFrame,
                     per_product: DataFrame | None = None) -> DataFrame:
    """t08: line revenue (quantity x item unit price) by product category.
    Columns: category, revenue_generated.  ``per_product`` is an already
    computed ``product_sales(items)``."""
    per_product = (per_product if per_product is not None else product_sales(items)) \
        .select("product_id", "revenue")
    joined = per_product.join(products.select("product_id", "category"), "product_id")
    return (joined.groupBy("category").agg(F.sum("revenue").alias("revenue"))
            .select("category", _money_out(F.col("revenue"), "revenue_generated"))
            .orderBy(F.col("revenue_generated").desc_nulls_last(),
                     F.col("category").asc_nulls_last()))


def last_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.max("order_date").alias("last_ordered_date"))


def churn_risk(orders: DataFrame, as_of=None, min_days: int = 7,
               per_customer: DataFrame | None = None) -> DataFrame:
    """t09: customers whose last order is at least ``min_days`` calendar days
    before ``as_of``.  Customers without orders never appear.
    Columns: customer_id, last_ordered_date, days_since_last_order."""
    days = F.datediff(as_of_column(as_of), F.col("last_ordered_date"))
    last = (per_customer.select("customer_id", F.col("last_order").alias("last_ordered_date"))
            if per_customer is not None else last_orders(orders))
    return (last
            .withColumn("days_since_last_order", days.cast("int"))
            .filter(F.col("days_since_last_order") >= min_days)
            .orderBy(F.col("days_since_last_order").desc(), F.col("customer_id")))
