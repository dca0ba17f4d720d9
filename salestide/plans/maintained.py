"""Registered queries over tables that streams maintain: trailing panes, the
latest version of a dimension, late rows and their repair, running windows.

Each replays stored tables as streams and reads the maintained table back;
its oracle is the batch result over the stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salestide import streaming
from salestide.operators import tables
from salestide.plans import catalog
from salestide.plans.bindings import EVENTS_AS_OF, ORDERS_AS_OF
from salestide.plans.catalog import C, EA, EO, I, O, ORACLES, P, SC, register
from salestide.session import remove_path, scratch_path
from salestide.sources import bucketed
from salestide.sources import stream as src_stream
from salestide.streaming import ingest, late, panes, upsert

# -- ST5: trailing look-backs from panes (k02, k10, k11, t07) -------------------

# the original's three hours, one whose bounds cut panes, one over many panes
LOOKBACKS = ("3 hours", "100 minutes", "37 hours")


def _lookback_sql(length: str) -> str:
    since = f"{EA} - interval {length}"
    before = f"{EA} - interval {length} - interval {length}"
    return f"""
select '{length}' as lookback,
  (select count(distinct customer_id) from {SC} s where signup_date >= {since}) as customers_in_last_3hrs,
  cur::double as sales_in_last3hrs,
  case when prev = 0 then (case when cur > 0 then 'inf'::double else 0.0 end)
       else ((cur - prev)::double / prev::double) * 100 end as growth_rate
from (select coalesce(sum(case when order_date >= {since} then total_amount end), 0) as cur,
             coalesce(sum(case when order_date < {since} then total_amount end), 0) as prev
      from {EO} o where order_date >= {before})"""


def _drain_panes(spark, df, name, root) -> None:
    path, files, _ = catalog._arriving(spark, df, panes.PANES[name].time)
    ck = scratch_path(spark, f"panes-{name}-ck")
    q = panes.start_panes(catalog._stream(spark, df, path, files), name, root, ck, trigger="availableNow")
    catalog._drained(spark, [q], path, ck)


@register("st5_trailing_kpis", " union all ".join(map(_lookback_sql, LOOKBACKS)))
def st5_trailing_kpis(spark, sf_dir):
    t, root = catalog._t(spark, sf_dir), scratch_path(spark, "panes")
    _drain_panes(spark, t.event_orders().select("order_date", "total_amount"), "sales", root)
    _drain_panes(spark, t.signup_customers().select("customer_id", "signup_date"), "signups", root)
    out = None
    for length in LOOKBACKS:
        one = spark.range(1).select(F.lit(length).alias("lookback"), *[
            df.scalar().alias(df.columns[0]) for df in (
                panes.new_customers(spark, root, EVENTS_AS_OF, length),
                panes.sales_window(spark, root, EVENTS_AS_OF, length),
                panes.growth_rate(spark, root, EVENTS_AS_OF, length))])
        out = one if out is None else out.unionByName(one)
    return out


# seven minutes past the hour, so that the look-back cuts a pane
TOP_AS_OF = ORDERS_AS_OF.replace("00:00:00", "00:07:00")


@register("st5_trailing_top_products", ORACLES["t07_top_products"].replace(ORDERS_AS_OF, TOP_AS_OF))
def st5_trailing_top_products(spark, sf_dir):
    """t07 from panes of items that carry their order's time."""
    t, root = catalog._t(spark, sf_dir), scratch_path(spark, "panes")
    times = t.orders().select("order_id", F.col("order_date").alias("order_time"))
    joined = scratch_path(spark, "timed-items")     # the replay reads its rows once for each slice
    t.order_items().join(times, "order_id").select("order_time", "product_id", "quantity").write.parquet(joined)
    _drain_panes(spark, spark.read.parquet(joined), "products", root)
    remove_path(spark, joined)
    return panes.top_products(spark, root, t.products(), TOP_AS_OF, catalog.TOP_PRODUCTS_LOOKBACK)


# -- ST4: the latest version of a dimension row ----------------------------------


def _upserted_customers(spark, sf_dir):
    """Customers sent in one to three versions, each version twice, in any
    order: the older ones have moved since."""
    customers = catalog._t(spark, sf_dir).customers()
    last = F.pmod(F.col("customer_id"), F.lit(3)).cast("int")
    day = F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")
    versions = customers.withColumn("v", F.explode(F.sequence(F.lit(0), last))).select(
        "customer_id", *[F.when(F.col("v") < last, F.concat(F.lit("old "), c)).otherwise(F.col(c)).alias(c)
                         for c in ("name", "location", "membership_type")],
        (day + F.make_dt_interval(days=F.col("v"))).alias("timestamp"))
    sent = versions.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    anyhow = F.timestamp_seconds(F.pmod(F.xxhash64(*sent.columns), F.lit(catalog.FEW_SLICES))).cast("timestamp_ntz")
    path, files, _ = catalog._arriving(spark, sent.withColumn("_at", anyhow), "_at")
    root, ck = scratch_path(spark, "customers"), scratch_path(spark, "customers-ck")
    stream = catalog._stream(spark, sent, path, files).drop("copy")
    q = upsert.start_upsert(stream, root, ck, "customer_id", "timestamp", buckets=8, trigger="availableNow")
    catalog._drained(spark, [q], path, ck)
    return upsert.latest(spark, root, versions.schema).drop("timestamp")


@register("st4_upsert_customers", f"select * from {C} c")
def st4_upsert_customers(spark, sf_dir):
    return _upserted_customers(spark, sf_dir)


_BY_CUSTOMER = ("customer_ltv", "regional_revenue", "membership_revenue")


@register("st4_upsert_tables", " union all ".join(
    f"{catalog._tagged(n)} from ({ORACLES[k]}) q" for n, k in zip(
        _BY_CUSTOMER, ("t01_customer_ltv", "t02_regional_revenue", "t03_membership_revenue"))
).replace("as string)", "as varchar)"))
def st4_upsert_tables(spark, sf_dir):
    """t01 to t03 over the maintained customers: repeats and old versions
    change nothing."""
    orders, customers = catalog._t(spark, sf_dir).orders(), _upserted_customers(spark, sf_dir)
    out = None
    for name, build in zip(_BY_CUSTOMER, (tables.customer_ltv, tables.regional_revenue, tables.membership_revenue)):
        part = build(orders, customers).selectExpr(*catalog._tagged(name)[len("select "):].split(", "))
        out = part if out is None else out.unionByName(part)
    return out


# -- ST2, ST3, ST4, ST6: late rows aside, and the repair -------------------------


def _landed(spark, df, time, **closing):
    """(landing folder, delay, on-time stream): a tenth of the rows comes
    three slices late, the delay is a tenth of one."""
    stream, delay, path, files = catalog._replay(
        spark, df, time, lambda row: F.when(F.pmod(row, F.lit(10)) == 0, 3).otherwise(0), 3, delay=0.1, **closing)
    out, ck = scratch_path(spark, "landing"), scratch_path(spark, "landing-ck")
    q = late.start_landing(stream, out, ck, time, delay, trigger="availableNow", files=files)
    catalog._drained(spark, [q], path, ck)
    return out, delay, late.on_time(spark, out, df.schema, batches_per_trigger=1, files=files)


def _newest(df, time):
    return df.agg(F.max(time)).first()[0]


@register("st2_late_repair", ORACLES["st2_windowed_top_products"])
def st2_late_repair(spark, sf_dir):
    t = catalog._t(spark, sf_dir)
    items = t.raw("lineitem").select(F.col("l_partkey").alias("product_id"),
                                     F.col("l_quantity").cast("int").alias("quantity"),
                                     F.col("l_shipdate").cast("timestamp_ntz").alias("ship_ts"))
    landing, delay, stream = _landed(spark, items, "ship_ts")
    out, ck = scratch_path(spark, "product-counts"), scratch_path(spark, "product-counts-ck")
    q = streaming.start_product_counts(stream, out, ck, "ship_ts", catalog.ST2_WINDOW, delay,
                                       trigger="availableNow")
    catalog._drained(spark, [q], ck)
    counts = late.repair_counts(spark.read.parquet(out), late.late(spark, landing, items.schema), "ship_ts",
                                catalog.ST2_WINDOW, until=F.lit(_newest(items, "ship_ts")).cast("timestamp_ntz"))
    return streaming.rank_counts(counts, t.products(), catalog.ST2_K)


@register("st3_late_repair", ORACLES["st3_churn_alerts"])
def st3_late_repair(spark, sf_dir):
    orders = catalog._t(spark, sf_dir).orders().select("customer_id", "order_date")
    landing, delay, stream = _landed(spark, orders, "order_date")
    out, ck = scratch_path(spark, "churn"), scratch_path(spark, "churn-ck")
    q = streaming.start_churn_alerts(stream, out, ck, min_days=7, delay=delay, trigger="availableNow")
    catalog._drained(spark, [q], ck)
    landed = spark.read.schema(orders.schema).parquet(f"{landing}/on_time")
    return late.repair_churn(spark.read.parquet(out), late.late(spark, landing, orders.schema), landed,
                             until=F.lit(_newest(orders, "order_date")).cast("timestamp_ntz"))


@register("st4_late_repair", catalog.O_OUT)
def st4_late_repair(spark, sf_dir):
    """Orders sent twice, the second copy often too late for the state that
    remembers the first."""
    orders = catalog._t(spark, sf_dir).orders()
    twice = orders.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    landing, delay, stream = _landed(spark, twice, "order_date", order_id=-1)
    out, ck = scratch_path(spark, "first-copies"), scratch_path(spark, "first-copies-ck")
    once = streaming.dedupe(stream.drop("copy"), "order_id", "order_date", delay)
    q = (once.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    catalog._drained(spark, [q], ck)
    rest = late.late(spark, landing, twice.schema).drop("copy")
    whole = late.repair_copies(spark.read.parquet(out), rest, "order_id", "order_date")
    return catalog._money_double(whole.where("order_id <> -1"))


@register("st6_late_repair", ORACLES["st6_windowed_revenue"])
def st6_late_repair(spark, sf_dir):
    orders = catalog._t(spark, sf_dir).event_orders().select("order_id", "order_date", "total_amount")
    landing, delay, stream = _landed(spark, orders, "order_date")
    out, ck = scratch_path(spark, "revenue"), scratch_path(spark, "revenue-ck")
    q = streaming.start_windowed_revenue(stream, out, ck, window="3 hours", delay=delay, trigger="availableNow")
    catalog._drained(spark, [q], ck)
    whole = late.repair_revenue(spark.read.parquet(out), late.late(spark, landing, orders.schema), "3 hours",
                                until=F.lit(_newest(orders, "order_date")).cast("timestamp_ntz"))
    return streaming.window_growth(whole)


# -- ST6: running sales -----------------------------------------------------------


@register("st6_trailing_revenue", f"""
with p as (select time_bucket(interval 15 minute, order_date, timestamp '1970-01-01') as pane,
                  sum(total_amount) as sales, count(*) as orders from {EO} o group by 1),
w as (select pane - k * interval 15 minute as ws, sales, orders from p, range(12) r(k))
select ws as window_start, ws + interval 3 hour as window_end, sum(sales)::double as sales,
       sum(orders)::bigint as orders
from w where ws + interval 3 hour <= (select max(order_date) from {EO} o2) group by ws
""")
def st6_trailing_revenue(spark, sf_dir):
    orders = catalog._t(spark, sf_dir).event_orders()
    stream, delay, path, _ = catalog._replay(spark, orders, "order_date")
    out, ck = scratch_path(spark, "trailing"), scratch_path(spark, "trailing-ck")
    q = streaming.start_trailing_revenue(stream, out, ck, "3 hours", "15 minutes", delay, trigger="availableNow")
    catalog._drained(spark, [q], path, ck)
    return catalog._money_double(spark.read.parquet(out), "sales")


# -- ST1, J6, J8: tables bucketed by the ingest ---------------------------------


def _bucketed(spark, df, time, key, columns):
    """``df`` streamed into a table bucketed by ``key``, as stored."""
    name = f"b{uuid.uuid4().hex[:12]}"
    kept = df.select(*columns)
    layout = bucketed.Layout(name, scratch_path(spark, f"bucketed-{name}"), key, 8, kept.schema)
    path, files, _ = catalog._arriving(spark, df, time)
    ck = scratch_path(spark, "bucketed-ck")
    q = bucketed.start_bucketed(catalog._stream(spark, df, path, files), [layout], ck, trigger="availableNow")
    catalog._drained(spark, [q], path, ck)
    return bucketed.open_table(spark, layout)


def _shipped_items(t):
    ship = t.raw("lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice")
    return ship.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                       F.col("l_quantity").cast("int").alias("quantity"),
                       F.col("l_extendedprice").cast("decimal(18,2)").alias("line_amount"),
                       F.col("l_shipdate").cast("timestamp_ntz").alias("shipped"))


@register("st1_bucketed_top_products", ORACLES["t07_top_products"])
def st1_bucketed_top_products(spark, sf_dir):
    """J6 over orders and items bucketed by order: the join exchanges neither."""
    t = catalog._t(spark, sf_dir)
    orders = _bucketed(spark, t.orders(), "order_date", "order_id", ("order_id", "order_date"))
    items = _bucketed(spark, _shipped_items(t), "shipped", "order_id", ("order_id", "product_id", "quantity"))
    return tables.top_products(orders, items, t.products(), as_of=ORDERS_AS_OF,
                               lookback=catalog.TOP_PRODUCTS_LOOKBACK)


@register("st1_bucketed_category_revenue", ORACLES["t08_category_revenue"])
def st1_bucketed_category_revenue(spark, sf_dir):
    """J8 over items and products bucketed by product: neither the sum per
    product nor the join exchanges anything."""
    t = catalog._t(spark, sf_dir)
    items = _bucketed(spark, _shipped_items(t), "shipped", "product_id", ("product_id", "quantity", "line_amount"))
    sent = F.timestamp_seconds(F.pmod("product_id", F.lit(86_400))).cast("timestamp_ntz")
    products = _bucketed(spark, t.products().withColumn("sent", sent), "sent", "product_id",
                         ("product_id", "category"))
    return tables.category_revenue(items, products)


# -- A5 by range, t07 from sketches -----------------------------------------------

_DAYS = (1, 7, 30)


@register("st5_distinct_by_range", f"""
with d as (select distinct signup_date::date as day from {SC} s),
r as (select day as first_day, n as days from d, (values {", ".join(f"({n})" for n in _DAYS)}) v(n))
select r.first_day, r.days::int as days, count(distinct s.customer_id) as exact_ids, true as within_error
from r join {SC} s on s.signup_date::date >= r.first_day and s.signup_date::date < r.first_day + r.days::int
group by 1, 2
""")
def st5_distinct_by_range(spark, sf_dir):
    """Customers who signed up in every run of days: the estimate from the
    sketches of panes lies within four standard errors of the exact count."""
    t, root = catalog._t(spark, sf_dir), scratch_path(spark, "panes")
    signups = t.signup_customers().select("customer_id", "signup_date")
    _drain_panes(spark, signups, "signup_sketches", root)
    estimate = panes.distinct_by_days(spark, root, "signup_sketches", _DAYS)
    ids = signups.select("customer_id", F.col("signup_date").cast("date").alias("day")).distinct()
    exact = (ids.withColumn("days", F.explode(F.array(*map(F.lit, _DAYS))))
             .withColumn("first_day", F.explode(F.expr("transform(sequence(0, days - 1), i -> date_sub(day, i))")))
             .groupBy("first_day", "days").agg(F.count_distinct("customer_id").alias("exact_ids")))
    off = F.abs(F.col("distinct_ids") - F.col("exact_ids"))
    return estimate.join(exact, ["first_day", "days"]).select(
        "first_day", "days", "exact_ids",
        (off <= F.greatest(F.lit(1.0), 4 * panes.RELATIVE_ERROR * F.col("exact_ids"))).alias("within_error"))


@register("t07_top_products_sketched", ORACLES["t07_top_products"])
def t07_top_products_sketched(spark, sf_dir):
    """t07 with sketches of the lines of each order day as candidate filter."""
    t = catalog._t(spark, sf_dir)
    since = F.lit(ORDERS_AS_OF).cast("timestamp_ntz") - F.expr(f"INTERVAL {catalog.TOP_PRODUCTS_LOOKBACK}")
    lines = t.order_items().join(t.orders().where(F.col("order_date") >= since).select("order_id", "order_date"),
                                 "order_id").select("product_id", "quantity", "order_date")
    daily = lines.groupBy("order_date").agg(
        F.expr(f"approx_top_k_accumulate(product_id, {tables.TRACKED})").alias("sketch"),
        F.count("product_id").alias("n"))
    return tables.top_from_sketch(lines, tables.merge_sketches(daily), t.products())


# -- S7, S8: fields outside the schema ---------------------------------------------


@register("s07_variant_landing", f"""
select order_id, customer_id, order_date, total_amount::double as total_amount, sales_channel, payment_method,
       'C' || (order_id % 97) as coupon_code, (order_id % 5)::int as coupon_uses from {O} o""")
def s07_variant_landing(spark, sf_dir):
    """Orders whose messages carry a nested field that the schema lacks,
    landed whole by a stream; columns and the field are extracted after."""
    orders = catalog._t(spark, sf_dir).orders()
    coupon = F.struct(F.concat(F.lit("C"), F.col("order_id") % 97).alias("code"),
                      (F.col("order_id") % 5).alias("uses"))
    messages = orders.select(F.lit("orders").alias("topic"), F.to_json(F.struct(
        *orders.columns, coupon.alias("coupon"))).alias("value"), F.col("order_date").alias("timestamp"))
    path, files, _ = catalog._arriving(spark, messages, "timestamp")
    out, ck = scratch_path(spark, "landed"), scratch_path(spark, "landed-ck")
    q = ingest.start_landing(catalog._stream(spark, messages, path, files), out, ck, trigger="availableNow")
    catalog._drained(spark, [q], path, ck)
    landed = spark.read.parquet(out).withColumns({
        "coupon_code": src_stream.landed_field("$.coupon.code", "string"),
        "coupon_uses": src_stream.landed_field("$.coupon.uses", "int")})
    return catalog._money_double(src_stream.extract(
        landed, schema=orders.schema, id_column="order_id", keep=("coupon_code", "coupon_uses")))


# -- F2, ST3 on a quiet stream --------------------------------------------------------


@register("f02_activation_dates", f"""
select customer_id, strftime(signup_date, '%Y-%m-%d %H:%M:%S') as cust_activation_date from {SC} s""")
def f02_activation_dates(spark, sf_dir):
    """the signup time as the text the original carried."""
    signups = catalog._t(spark, sf_dir).signup_customers()
    return signups.select("customer_id", F.date_format("signup_date", "yyyy-MM-dd HH:mm:ss")
                          .alias("cust_activation_date"))
