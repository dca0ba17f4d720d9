"""Registered queries over the stored tables, each with its SQL oracle.

Every entry binds the canonical relations to the driver's tables
(``bindings.StoredTables``), runs one operator over the whole tables and
returns the DataFrame.  ``ORACLES`` holds an independent SQL formulation of
the same result for DuckDB, with the same column names and types.  Source,
sink and streaming entries write through Spark (under the session's
checkpoint folder) and read their output back; their oracles describe the
rows that must come out (for streams: the windows closed by the watermark).
"""

from __future__ import annotations

import datetime as dt
import functools
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestide import streaming
from salestide.operators import extensions, kpis, tables, views
from salestide.plans.bindings import (
    EVENTS_AS_OF, ORDERS_AS_OF, StoredTables,
)
from salestide.plans.job import Relations, kpi_outputs, run_batch
from salestide.schemas import RELATIONS
from salestide.session import remove_path, scratch_path
from salestide.sources import files as src_files
from salestide.sources import results as src_results
from salestide.sources import stream as src_stream
from salestide.sources.sinks import write_result
from salestide.streaming import incremental
from salestide.streaming.common import fill_batch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


# ---------------------------------------------------------------------------
# SQL bindings of the canonical relations (mirror bindings.StoredTables).
O = """(select o_orderkey as order_id, o_custkey as customer_id,
          o_orderdate as order_date, o_totalprice::decimal(18,2) as total_amount,
          o_orderstatus as sales_channel, o_orderpriority as payment_method
   from orders)"""
C = """(select c_custkey as customer_id, c_name as name, n_name as location,
          c_mktsegment as membership_type
   from customer left join nation on c_nationkey = n_nationkey)"""
P = """(select p_partkey as product_id, p_type as category, p_name as name,
          p_retailprice::decimal(18,2) as price from part)"""
I = """(select l_orderkey as order_id, l_partkey as product_id,
          l_quantity::int as quantity, l_extendedprice::decimal(18,2) as line_amount
   from lineitem)"""
EO = """(select event_id as order_id, user_id as customer_id, ts as order_date,
           value::decimal(18,2) as total_amount
    from events where event_type = 'purchase')"""
SC = """(select user_id as customer_id, ts as signup_date
    from events where event_type = 'signup')"""
EC = f"""(select customer_id, min(signup_date) as signup_date from {SC} s group by customer_id)"""

OA = f"timestamp '{ORDERS_AS_OF}'"
EA = f"timestamp '{EVENTS_AS_OF}'"

# Test parameters: the original job's constants where the stored data allows
# them; day-sized lookbacks on orders, whose times are whole dates.
TOP_PRODUCTS_LOOKBACK = "30 days"
SUMMARY_LOOKBACK = "3 hours"


def _t(spark, sf_dir) -> StoredTables:
    return StoredTables(spark, sf_dir)


# -- KPI tables ---------------------------------------------------------------

@register("t01_customer_ltv", f"""
with per as (
  select time_bucket(interval 10 day, order_date, timestamp '1970-01-01') as ws,
         customer_id, sum(total_amount) as ltv
  from {O} o group by 1, 2),
j as (
  select ws, per.customer_id, c.name, sum(ltv) as ltv
  from per join {C} c on per.customer_id = c.customer_id group by 1, 2, 3),
r as (
  select *, row_number() over (partition by ws order by ltv desc, customer_id, name) as rk
  from j)
select customer_id, name, round(ltv, 2)::double as customer_ltv, rk::int as rank,
       ws as window_start, ws + interval 10 day as window_end
from r where rk <= 5
""")
def t01_customer_ltv(spark, sf_dir):
    t = _t(spark, sf_dir)
    return tables.customer_ltv(t.orders(), t.customers())


@register("t02_regional_revenue", f"""
select c.location, round(sum(o.total_amount), 2)::double as total_revenue
from {O} o join {C} c on o.customer_id = c.customer_id
group by c.location
order by sum(o.total_amount) desc nulls last, c.location nulls last
limit 10
""")
def t02_regional_revenue(spark, sf_dir):
    t = _t(spark, sf_dir)
    return tables.regional_revenue(t.orders(), t.customers())


@register("t03_membership_revenue", f"""
select c.membership_type, round(sum(o.total_amount), 2)::double as revenue_generated
from {O} o join {C} c on o.customer_id = c.customer_id
group by c.membership_type
""")
def t03_membership_revenue(spark, sf_dir):
    t = _t(spark, sf_dir)
    return tables.membership_revenue(t.orders(), t.customers())


@register("t04_monthly_sales", f"""
select month(order_date)::int as order_month, sum(total_amount)::double as monthly_sales
from {O} o group by 1
""")
def t04_monthly_sales(spark, sf_dir):
    return tables.sales_by(_t(spark, sf_dir).orders(), "month")


@register("t05_weekday_sales", f"""
select (dayofweek(order_date) + 1)::int as order_weekday,
       sum(total_amount)::double as weekday_sales
from {O} o group by 1
""")
def t05_weekday_sales(spark, sf_dir):
    return tables.sales_by(_t(spark, sf_dir).orders(), "weekday")


@register("t06_hourly_sales", f"""
select hour(order_date)::int as order_hour, sum(total_amount)::double as hourly_sales
from {EO} o group by 1
""")
def t06_hourly_sales(spark, sf_dir):
    return tables.sales_by(_t(spark, sf_dir).event_orders(), "hour")


@register("t07_top_products", f"""
with recent as (
  select order_id from {O} o where order_date >= {OA} - interval {TOP_PRODUCTS_LOOKBACK}),
per as (
  select i.product_id, count(i.quantity) as sold_quantity
  from {I} i join recent r on i.order_id = r.order_id group by i.product_id)
select p.name, per.sold_quantity
from per left join {P} p on per.product_id = p.product_id
order by per.sold_quantity desc, per.product_id, p.name nulls first
limit 10
""")
def t07_top_products(spark, sf_dir):
    t = _t(spark, sf_dir)
    return tables.top_products(t.orders(), t.order_items(), t.products(),
                               as_of=ORDERS_AS_OF, lookback=TOP_PRODUCTS_LOOKBACK)


@register("t08_category_revenue", f"""
select p.category, round(sum(i.line_amount), 2)::double as revenue_generated
from {I} i join {P} p on i.product_id = p.product_id
group by p.category
""")
def t08_category_revenue(spark, sf_dir):
    t = _t(spark, sf_dir)
    return tables.category_revenue(t.order_items(), t.products())


@register("t09_churn_risk", f"""
select customer_id, max(order_date) as last_ordered_date,
       date_diff('day', max(order_date)::date, {OA}::date)::int as days_since_last_order
from {O} o group by customer_id
having date_diff('day', max(order_date)::date, {OA}::date) >= 7
""")
def t09_churn_risk(spark, sf_dir):
    return tables.churn_risk(_t(spark, sf_dir).orders(), as_of=ORDERS_AS_OF)


# -- scalar KPIs ----------------------------------------------------------------

K01 = f"select count(*) as total_orders_count from {O} o"
K02 = (f"select count(distinct customer_id) as customers_in_last_3hrs from {SC} s "
       f"where signup_date >= {EA} - interval 3 hour")
K03 = f"select sum(total_amount)::double as total_sales_amount from {O} o"
K04 = f"select sum(quantity)::bigint as total_items_sold from {I} i"
K05 = f"select count(distinct product_id) as total_products_sold from {I} i"
K06 = f"select sum(total_amount)::double / count(*) as aov from {O} o"
K07 = (f"select case when count(*) > 0 then 50000.0::double / count(*) else 0.0 end as cac "
       f"from {C} c")
# Per-customer delay in hundredths of an hour, rounded half-up from whole
# seconds: (|s| + 18) // 36 with the sign of s.
K08_ROWS = f"""
with f as (select customer_id, min(order_date) as first_purchase_date from {EO} o group by 1),
d as (
  select e.customer_id, f.first_purchase_date, e.signup_date,
         epoch_us(f.first_purchase_date) // 1000000 - epoch_us(e.signup_date) // 1000000 as s
  from {EC} e join f on e.customer_id = f.customer_id)
select customer_id, signup_date, first_purchase_date,
       (sign(s) * ((abs(s) + 18) // 36))::decimal(38,0) * 0.01 as h from d"""
K08 = f"select sum(h)::double / count(h) as avg_time from ({K08_ROWS}) x"
K09 = f"""
with per as (select customer_id, count(order_id) as n from {O} o group by 1)
select (sum(case when n >= 2 then 1 else 0 end)::double / count(*)) * 100
       as percent_repeat_customers from per"""
K10 = (f"select coalesce(sum(total_amount), 0)::double as sales_in_last3hrs from {EO} o "
       f"where order_date >= {EA} - interval 3 hour")
K11 = f"""
with s as (
  select coalesce(sum(case when order_date >= {EA} - interval 3 hour then total_amount end), 0) as cur,
         coalesce(sum(case when order_date < {EA} - interval 3 hour then total_amount end), 0) as prev
  from {EO} o where order_date >= {EA} - interval 6 hour)
select case when prev = 0 then (case when cur > 0 then 'inf'::double else 0.0 end)
            else ((cur - prev)::double / prev::double) * 100 end as growth_rate
from s"""
K12 = f"""
with j as (
  select i.quantity as q, p.price from {I} i left join {P} p on i.product_id = p.product_id),
a as (select sum(q * (price * 0.7)) as cogs, sum(q) as units from j)
select coalesce(cogs::double, 0.0)
       / ((case when coalesce(units, 0) = 0 then 1 else units end)::double / 2.0)
       as inventory_turnover from a"""


@register("k01_total_orders", K01)
def k01_total_orders(spark, sf_dir):
    return kpis.total_orders(_t(spark, sf_dir).orders())


@register("k02_new_customers", K02)
def k02_new_customers(spark, sf_dir):
    return kpis.new_customers(_t(spark, sf_dir).signup_customers(), as_of=EVENTS_AS_OF)


@register("k03_total_sales", K03)
def k03_total_sales(spark, sf_dir):
    return kpis.total_sales(_t(spark, sf_dir).orders())


@register("k04_items_sold", K04)
def k04_items_sold(spark, sf_dir):
    return kpis.items_sold(_t(spark, sf_dir).order_items())


@register("k05_unique_products", K05)
def k05_unique_products(spark, sf_dir):
    return kpis.unique_products(_t(spark, sf_dir).order_items())


@register("k06_aov", K06)
def k06_aov(spark, sf_dir):
    return kpis.average_order_value(_t(spark, sf_dir).orders())


@register("k07_cac", K07)
def k07_cac(spark, sf_dir):
    return kpis.acquisition_cost(_t(spark, sf_dir).customers())


@register("k08_conversion_time", K08)
def k08_conversion_time(spark, sf_dir):
    t = _t(spark, sf_dir)
    return kpis.avg_conversion_delay(t.event_customers(), t.event_orders())


@register("k08_conversion_delay_rows", f"""
select customer_id, signup_date as cust_activation_date, first_purchase_date,
       h::double as interval_for_first_order_hour from ({K08_ROWS}) x
""")
def k08_conversion_delay_rows(spark, sf_dir):
    t = _t(spark, sf_dir)
    df = kpis.conversion_delay(t.event_customers(), t.event_orders())
    return df.select("customer_id", "cust_activation_date", "first_purchase_date",
                     df["interval_for_first_order_hour"].cast("double")
                     .alias("interval_for_first_order_hour"))


@register("k09_retention", K09)
def k09_retention(spark, sf_dir):
    return kpis.retention_pct(_t(spark, sf_dir).orders())


@register("k10_sales_window", K10)
def k10_sales_window(spark, sf_dir):
    return kpis.sales_window(_t(spark, sf_dir).event_orders(), as_of=EVENTS_AS_OF)


@register("k11_growth_rate", K11)
def k11_growth_rate(spark, sf_dir):
    return kpis.growth_rate(_t(spark, sf_dir).event_orders(), as_of=EVENTS_AS_OF)


@register("k12_inventory_turnover", K12)
def k12_inventory_turnover(spark, sf_dir):
    t = _t(spark, sf_dir)
    return kpis.inventory_turnover(t.order_items(), t.products())


@register("k13_kpi_summary", f"""
select ({K01}) as total_orders_count, ({K02}) as customers_in_last_3hrs,
       ({K03}) as total_sales_amount, ({K04}) as total_items_sold,
       ({K05}) as total_products_sold, ({K06}) as aov, ({K07}) as cac,
       ({K08}) as avg_time, ({K09}) as percent_repeat_customers,
       ({K10}) as sales_in_last3hrs, ({K11}) as growth_rate,
       ({K12}) as inventory_turnover
""")
def k13_kpi_summary(spark, sf_dir):
    # Orders (whole dates) feed the all-time KPIs; purchase and signup events
    # (sub-second times) feed the 3-hour window and conversion KPIs.
    t = _t(spark, sf_dir)
    return kpis.kpi_summary(
        t.customers(), t.products(), t.orders(), t.order_items(), as_of=EVENTS_AS_OF,
        lookback=SUMMARY_LOOKBACK, period=SUMMARY_LOOKBACK,
        new_customer_rows=t.signup_customers(), recent_orders=t.event_orders(),
        signups=t.event_customers(), first_orders=t.event_orders())


# -- dashboard views ------------------------------------------------------------

T02, T03, T04 = ORACLES["t02_regional_revenue"], ORACLES["t03_membership_revenue"], \
    ORACLES["t04_monthly_sales"]
T05, T06, T08 = ORACLES["t05_weekday_sales"], ORACLES["t06_hourly_sales"], \
    ORACLES["t08_category_revenue"]


def _share_sql(table_sql: str, label: str, value: str) -> str:
    return f"""
with t as ({table_sql}),
c as (select {label} as label, {value} as revenue from t
      where {label} is not null and {value} is not null)
select label, revenue,
       revenue / (select sum(revenue::decimal(38,2))::double from c) as percent
from c"""


@register("v01_category_share", _share_sql(T08, "category", "revenue_generated"))
def v01_category_share(spark, sf_dir):
    return views.category_share(t08_category_revenue(spark, sf_dir))


@register("v02_location_share", _share_sql(T02, "location", "total_revenue"))
def v02_location_share(spark, sf_dir):
    return views.location_share(t02_regional_revenue(spark, sf_dir))


@register("v03_weekday_named", f"""
with t as ({T05})
select order_weekday,
       case order_weekday when 1 then 'Sun' when 2 then 'Mon' when 3 then 'Tue'
            when 4 then 'Wed' when 5 then 'Thu' when 6 then 'Fri' when 7 then 'Sat' end
         as weekday,
       weekday_sales
from t where order_weekday is not null and weekday_sales is not null
""")
def v03_weekday_named(spark, sf_dir):
    return views.weekday_named(t05_weekday_sales(spark, sf_dir))


@register("v04_membership_clean", f"""
with t as ({T03})
select membership_type as label, revenue_generated as revenue from t
where membership_type is not null and revenue_generated is not null
""")
def v04_membership_clean(spark, sf_dir):
    return views.membership_clean(t03_membership_revenue(spark, sf_dir))


@register("v05_monthly_trend", f"""
with t as ({T04})
select order_month::int as order_month, monthly_sales::double as monthly_sales from t
where order_month is not null and monthly_sales is not null
""")
def v05_monthly_trend(spark, sf_dir):
    return views.trend_clean(t04_monthly_sales(spark, sf_dir))


@register("v05_hourly_trend", f"""
with t as ({T06})
select order_hour::int as order_hour, hourly_sales::double as hourly_sales from t
where order_hour is not null and hourly_sales is not null
""")
def v05_hourly_trend(spark, sf_dir):
    return views.trend_clean(t06_hourly_sales(spark, sf_dir))


# -- extensions (requirements never computed by the original job) ---------------

@register("d01_customer_distribution", f"""
select membership_type, count(distinct customer_id) as customer_count,
       (count(distinct customer_id)::double
        / (select count(distinct customer_id) from {C} c2)) * 100 as percent
from {C} c group by membership_type
""")
def d01_customer_distribution(spark, sf_dir):
    # The stored customers carry no gender; the market segment stands in.
    return extensions.customer_distribution(_t(spark, sf_dir).customers(), by="membership_type")


@register("d02_total_customers",
          f"select count(distinct customer_id) as total_customers from {C} c")
def d02_total_customers(spark, sf_dir):
    return extensions.total_customers(_t(spark, sf_dir).customers())


@register("d03_total_products",
          f"select count(distinct product_id) as total_products from {P} p")
def d03_total_products(spark, sf_dir):
    return extensions.total_products(_t(spark, sf_dir).products())


@register("d04_top_selling_products", f"""
with u as (select product_id, sum(quantity)::bigint as units_sold from {I} i group by 1)
select u.product_id, p.name, u.units_sold
from u left join {P} p on u.product_id = p.product_id
order by u.units_sold desc, u.product_id, p.name nulls first
limit 10
""")
def d04_top_selling_products(spark, sf_dir):
    t = _t(spark, sf_dir)
    return extensions.top_selling_products(t.order_items(), t.products())


@register("d05_sales_per_customer", f"""
select customer_id, count(order_id) as order_count, sum(total_amount)::double as total_sales,
       sum(total_amount)::double / count(order_id)::double as avg_order_value
from {O} o group by customer_id
""")
def d05_sales_per_customer(spark, sf_dir):
    return extensions.sales_per_customer(_t(spark, sf_dir).orders())


@register("d06_conversion_rate", """
with l as (select distinct user_id from events where event_type = 'view' and user_id is not null),
b as (select distinct user_id from events where event_type = 'purchase' and user_id is not null)
select count(*) as leads, count(b.user_id) as converted,
       (count(b.user_id)::double / count(*)) * 100 as conversion_rate_pct
from l left join b on l.user_id = b.user_id
""")
def d06_conversion_rate(spark, sf_dir):
    from pyspark.sql import functions as F
    ev = _t(spark, sf_dir).raw("events")
    visitors = ev.where(F.col("event_type") == "view").select(F.col("user_id").alias("customer_id"))
    buyers = ev.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("customer_id"))
    return extensions.conversion_rate(visitors, buyers)


@register("d07_retention_in_period", f"""
with g as (
  select customer_id, order_date,
         lag(order_date) over (partition by customer_id order by order_date) as prev
  from {O} o where order_date is not null),
per as (
  select customer_id,
         max(case when prev is not null and order_date <= prev + interval 30 day
                  then 1 else 0 end) as r
  from g group by customer_id)
select count(*) as customers, sum(r)::bigint as repeat_customers,
       (sum(r)::double / count(*)) * 100 as retention_pct
from per
""")
def d07_retention_in_period(spark, sf_dir):
    return extensions.retention_in_period(_t(spark, sf_dir).orders(), period="30 days")


@register("d08_gross_margin", f"""
with j as (select i.quantity as q, i.line_amount, p.price
           from {I} i left join {P} p on i.product_id = p.product_id),
a as (select sum(line_amount) as rev, sum(q * (price * 0.7)) as cogs from j)
select rev::double as revenue, cogs::double as cogs,
       ((rev - coalesce(cogs, 0))::double / rev::double) * 100 as gross_margin_pct
from a
""")
def d08_gross_margin(spark, sf_dir):
    t = _t(spark, sf_dir)
    return extensions.gross_margin(t.order_items(), t.products())


@register("d09_cac_new_only", f"""
select case when count(distinct customer_id) > 0
            then 50000.0::double / count(distinct customer_id) else 0.0 end as cac_new
from {SC} s where signup_date >= {EA} - interval 3 hour
""")
def d09_cac_new_only(spark, sf_dir):
    return extensions.cac_new_only(_t(spark, sf_dir).signup_customers(), as_of=EVENTS_AS_OF)


@register("d10_growth_by_period", f"""
with per as (select date_trunc('month', order_date) as period_start,
                    sum(total_amount) as sales from {O} o group by 1)
select a.period_start, a.sales::double as sales, b.sales::double as prev_sales,
       case when b.sales is null then null
            when b.sales = 0 then (case when a.sales > 0 then 'inf'::double else 0.0 end)
            else ((a.sales - b.sales)::double / b.sales::double) * 100 end as growth_pct
from per a left join per b on a.period_start = b.period_start + interval 1 month
""")
def d10_growth_by_period(spark, sf_dir):
    return extensions.growth_by_period(_t(spark, sf_dir).orders(), unit="month")


@register("d11_year_month_trend", f"""
select year(order_date)::int as order_year, month(order_date)::int as order_month,
       sum(total_amount)::double as sales
from {O} o group by 1, 2
""")
def d11_year_month_trend(spark, sf_dir):
    return extensions.year_month_trend(_t(spark, sf_dir).orders())


@register("d12_sales_by_channel", f"""
select sales_channel, payment_method, count(*) as order_count,
       sum(total_amount)::double as sales
from {O} o group by 1, 2
""")
def d12_sales_by_channel(spark, sf_dir):
    return extensions.sales_by_channel(_t(spark, sf_dir).orders())


# -- sources and sinks (round trips through Spark-written files) -----------------


O_OUT = f"""
select order_id, customer_id, order_date, total_amount::double as total_amount,
       sales_channel, payment_method from {O} o"""


def _money_double(df: DataFrame, col: str = "total_amount") -> DataFrame:
    return df.withColumn(col, F.col(col).cast("double"))


def _csv_copy(spark, df: DataFrame, name: str) -> str:
    """``df`` as CSV text, its columns in reverse order, plus one copy of the
    header line inside a part file (the defect of an append-only consumer)."""
    columns = df.columns[::-1]
    text = df.select([F.col(c).cast("string").alias(c) for c in columns])
    header = spark.createDataFrame([tuple(columns)], text.schema)
    path = scratch_path(spark, f"{name}-csv")
    text.unionByName(header).write.option("header", True).csv(path)
    return path


@register("s01_csv_ingest", O_OUT)
def s01_csv_ingest(spark, sf_dir):
    orders = _t(spark, sf_dir).orders()
    path = _csv_copy(spark, orders, "orders")
    return _money_double(src_files.read_relation(spark, path, "orders", schema=orders.schema))


@register("s01_csv_customers", f"select * from {C} c")
def s01_csv_customers(spark, sf_dir):
    customers = _t(spark, sf_dir).customers()
    path = _csv_copy(spark, customers, "customers")
    back = src_files.read_relation(spark, path, "customers", schema=customers.schema)
    return back.select("customer_id", "name", "location", "membership_type")


@register("s01_csv_products", f"""
select product_id, category, name, price::double as price from {P} p""")
def s01_csv_products(spark, sf_dir):
    products = _t(spark, sf_dir).products()
    path = _csv_copy(spark, products, "products")
    return _money_double(src_files.read_relation(spark, path, "products", schema=products.schema), "price")


@register("s01_csv_items", f"""
select order_id, product_id, quantity, line_amount::double as line_amount from {I} i""")
def s01_csv_items(spark, sf_dir):
    items = _t(spark, sf_dir).order_items()
    path = _csv_copy(spark, items, "order-items")
    back = src_files.read_relation(spark, path, "order_items", schema=items.schema)
    return _money_double(back.select("order_id", "product_id", "quantity", "line_amount"), "line_amount")


@register("s02_json_decode", O_OUT)
def s02_json_decode(spark, sf_dir):
    t = _t(spark, sf_dir)
    orders, products = t.orders(), t.products()
    messages = src_stream.to_messages(orders, "orders-topic").unionByName(
        src_stream.to_messages(products, "products-topic"))
    routed = src_stream.route(messages, {"orders-topic": "orders", "products-topic": "products"},
                              schemas={"orders": orders.schema, "products": products.schema})
    return _money_double(routed["orders"])


@register("s03_result_roundtrip", T08)
def s03_result_roundtrip(spark, sf_dir):
    df = t08_category_revenue(spark, sf_dir)
    path = scratch_path(spark, "category-revenue")
    write_result(df, path, single_file=True)
    return src_results.read_result(spark, path, df.schema)


@register("s04_summary_roundtrip", ORACLES["k13_kpi_summary"])
def s04_summary_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "summary")
    write_result(k13_kpi_summary(spark, sf_dir), path, single_file=True)
    return src_results.read_summary(spark, path)


# -- streaming (file-source streams drained with availableNow) ------------------


REPLAY_SLICES = 8            # micro-batches of a replay in which windows close, in order of time
FEW_SLICES = 3               # of one where event time closes nothing
REPLAY_FILE_ROWS = 500_000
REPLAY_TASK_ROWS = 50_000    # fewer are not worth a task of their own
# a hash of the row, where the caller has a cheaper one than that of all columns; not written
ROW_HASH = "_row"


def _arriving(spark, df: DataFrame, time: str, late=None, most: int = 1, slices: int = FEW_SLICES
              ) -> tuple[str, int, int]:
    """(folder, files a micro-batch, seconds a slice): ``df`` as files that
    arrive in so many slices of its span of times.  ``late`` gives from a
    row's hash by how many slices, 0 to ``most``, it comes late (by default
    every other row comes one late).

    Each slice is read from ``df`` and written once, without a shuffle: ``df``
    should be cheap to read again (a scan, not a join of large tables).  Every
    slice has the same number of files, empty ones if need be, so a stream
    that takes so many at a time takes whole slices."""
    path = scratch_path(spark, "replay")
    ts = F.col(time).cast("timestamp_ntz")
    low, high, n = df.agg(F.min(ts), F.max(ts), F.count(F.lit(1))).first()
    low = low or dt.datetime(1970, 1, 1)
    seconds = ((high or low) - low) // dt.timedelta(seconds=slices) + 1
    row = F.col(ROW_HASH) if ROW_HASH in df.columns else F.xxhash64(*df.columns)
    after = late(row) if late else F.pmod(row, F.lit(2)).cast("int")

    def since(k: int):
        first = low + dt.timedelta(seconds=k * seconds)
        return ts >= F.lit(first.isoformat(sep=" ")).cast("timestamp_ntz") if first <= (high or low) else F.lit(False)

    def lies_in(k: int):        # rows without a time lie in the first slice
        within = since(k) & ~since(k + 1) if k else ~since(1)
        return F.coalesce(within, F.lit(k == 0))

    files = max(n // (slices * REPLAY_FILE_ROWS) + 1,
                min(spark.sparkContext.defaultParallelism, n // (slices * REPLAY_TASK_ROWS) + 1))
    for k in range(slices + most):
        # one after the other: a file source takes files by their time
        mine = [lies_in(k - d) & (after == d) for d in range(most + 1) if 0 <= k - d < slices]
        part = df.where(functools.reduce(Column.__or__, mine)).drop(ROW_HASH)
        part.coalesce(files).write.mode("append").option("compression", "zstd").parquet(path)
        fill_batch(spark, path, part.schema, files)
    return path, files, seconds


def _stream(spark, df: DataFrame, path: str, files: int) -> DataFrame:
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def _replay(spark, df: DataFrame, time: str, late=None, most: int = 1, delay: float = 1.0,
            slices: int = REPLAY_SLICES, **closing):
    """(stream, delay, folder, files a micro-batch): ``df`` as a stream of
    micro-batches in order of time, but for the rows that ``late`` holds back.
    The delay (in slices) covers that disorder by default, so windows close
    all along; a last row, one delay after the newest, moves the watermark up
    to the newest row.  It is NULL but for its time and ``closing``."""
    path, files, seconds = _arriving(spark, df, time, late, most, slices)
    df = df.drop(ROW_HASH)
    wait = f"INTERVAL {int(seconds * delay) + 1} SECONDS"
    kind = df.schema[time].dataType
    end = df.agg(F.max(time).alias("hi")).select(*[
        (F.col("hi").cast("timestamp_ntz") + F.expr(wait)).cast(kind).alias(f.name) if f.name == time
        else F.lit(closing.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    end.write.mode("append").parquet(path)
    return _stream(spark, df, path, files), wait[len("INTERVAL "):].lower(), path, files


def _drained(spark, queries, *folders) -> None:
    """Wait for ``queries``; no row may have come too late; delete their inputs and state."""
    for q in queries:
        q.awaitTermination()
        if streaming.late_rows(q):
            raise RuntimeError(f"{streaming.late_rows(q)} rows came after the watermark")
    for path in folders:
        remove_path(spark, path)


def _ingest(spark, relation: str, df: DataFrame, sent, copies: int, dedup: str | None,
            closing_id=None) -> DataFrame:
    """``df`` published ``copies`` times as messages at times ``sent`` (each
    later copy five minutes after the one before), ingested in micro-batches
    of time, de-duplicated by the relation's id and the message time."""
    key = RELATIONS[relation][1]
    stamped = df.withColumn("timestamp", sent)
    msgs = None
    for n in range(copies):
        m = stamped.select(F.lit("t").alias("topic"), F.to_json(F.struct(*df.columns)).alias("value"),
                           (F.col("timestamp") + F.expr(f"INTERVAL {5 * n} MINUTES")).alias("timestamp"),
                           F.xxhash64(*df.columns, F.lit(n)).alias(ROW_HASH))
        msgs = m if msgs is None else msgs.unionByName(m)
    last = f'{{"{key}": {json.dumps(closing_id)}}}'
    stream, delay, path, _ = _replay(spark, msgs, "timestamp", topic="t", value=last)
    out, ck = scratch_path(spark, "ingest-out"), scratch_path(spark, "ingest-ck")
    qs = streaming.start_ingest(stream, out, ck, {"t": relation}, trigger="availableNow",
                                schemas={relation: df.schema}, keep=("timestamp",),
                                dedup={relation: (key, "timestamp", delay, dedup)} if dedup else None)
    _drained(spark, qs, path, ck)
    return spark.read.parquet(f"{out}/{relation}").where(F.col(key) != closing_id).drop("timestamp")


def _order_messages(spark, sf_dir, copies: int, dedup: str | None) -> DataFrame:
    orders = _t(spark, sf_dir).orders()
    return _money_double(_ingest(spark, "orders", orders, F.col("order_date"), copies, dedup, -1))


@register("st1_stream_ingest", O_OUT)
def st1_stream_ingest(spark, sf_dir):
    return _order_messages(spark, sf_dir, copies=1, dedup=None)


@register("st4_dedup_ingest", O_OUT)
def st4_dedup_ingest(spark, sf_dir):
    return _order_messages(spark, sf_dir, copies=2, dedup="first_seen")


@register("st4_dedup_customers", f"select * from {C} c")
def st4_dedup_customers(spark, sf_dir):
    customers = _t(spark, sf_dir).customers()
    sent = F.lit("2001-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        mins=F.pmod("customer_id", F.lit(1440)).cast("int"))
    got = _ingest(spark, "customers", customers, sent, 2, "first_seen", -1)
    return got.select("customer_id", "name", "location", "membership_type")


@register("st4_dedup_items", """
select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
       || '-' || cast(round(l_extendedprice * 100) as bigint) as item_id, l_orderkey as order_id, l_partkey as product_id,
       l_quantity::int as quantity from lineitem""")
def st4_dedup_items(spark, sf_dir):
    raw = _t(spark, sf_dir).raw("lineitem")
    items = raw.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                   F.round(F.col("l_extendedprice") * 100).cast("long")).alias("item_id"),
                       F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                       F.col("l_quantity").cast("int").alias("quantity"),
                       F.col("l_extendedprice").cast("decimal(18,2)").alias("line_amount"),
                       F.col("l_shipdate").alias("ship"))
    sent = F.col("ship").cast("timestamp_ntz")
    got = _ingest(spark, "order_items", items, sent, 2, "first_seen", "end")
    return got.select("item_id", "order_id", "product_id", "quantity")


@register("st4_dedup_collapse", O_OUT)
def st4_dedup_collapse(spark, sf_dir):
    # copies collapse map-side when they carry the same event time
    orders = _t(spark, sf_dir).orders()
    twice = orders.unionAll(orders)
    stream, delay, path, _ = _replay(spark, twice, "order_date", order_id=-1)
    out, ck = scratch_path(spark, "collapse"), scratch_path(spark, "collapse-ck")
    once = streaming.dedupe(stream, "order_id", "order_date", delay, "collapse")
    q = (once.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    _drained(spark, [q], path, ck)
    return _money_double(spark.read.parquet(out))


ST2_WINDOW, ST2_K = "30 days", 3


@register("st2_windowed_top_products", f"""
with li as (select l_partkey as product_id, l_quantity, l_shipdate as ts from lineitem),
c as (select time_bucket(interval {ST2_WINDOW}, ts, timestamp '1970-01-01') as ws,
             product_id, count(l_quantity) as sold_quantity from li group by 1, 2),
r as (select *, row_number() over (partition by ws order by sold_quantity desc, product_id) as rk
      from c)
select r.ws as window_start, r.ws + interval {ST2_WINDOW} as window_end, r.product_id, p.name,
       r.sold_quantity, r.rk::int as rank
from r left join {P} p on r.product_id = p.product_id
where r.rk <= {ST2_K} and r.ws + interval {ST2_WINDOW} <= (select max(ts) from li)
""")
def st2_windowed_top_products(spark, sf_dir):
    t = _t(spark, sf_dir)
    items = t.raw("lineitem").select(F.col("l_partkey").alias("product_id"),
                                     F.col("l_quantity").cast("int").alias("quantity"),
                                     F.col("l_shipdate").alias("ship_ts"))
    stream, delay, path, _ = _replay(spark, items, "ship_ts")
    out, ck = scratch_path(spark, "top-products"), scratch_path(spark, "top-products-ck")
    q = streaming.start_top_products(stream, out, ck, event_time="ship_ts",
                                     products=t.products(), window=ST2_WINDOW, k=ST2_K,
                                     delay=delay, trigger="availableNow")
    _drained(spark, [q], path, ck)
    return spark.read.parquet(out).drop("batch_id")


@register("st6_windowed_revenue", f"""
with w as (select time_bucket(interval 3 hour, order_date, timestamp '1970-01-01') as ws,
                  sum(total_amount) as sales from {EO} o group by 1),
c as (select * from w
      where ws + interval 3 hour <= (select max(order_date) from {EO} o2))
select a.ws as window_start, a.ws + interval 3 hour as window_end, a.sales::double as sales,
       b.sales::double as prev_sales,
       case when b.sales is null then null
            when b.sales = 0 then (case when a.sales > 0 then 'inf'::double else 0.0 end)
            else ((a.sales - b.sales)::double / b.sales::double) * 100 end as growth_pct
from c a left join c b on a.ws = b.ws + interval 3 hour
""")
def st6_windowed_revenue(spark, sf_dir):
    t = _t(spark, sf_dir)
    orders = t.raw("events").where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("order_id"), F.col("user_id").alias("customer_id"),
        F.col("ts").alias("order_date"), F.col("value").cast("decimal(18,2)").alias("total_amount"))
    stream, delay, path, _ = _replay(spark, orders, "order_date")
    out, ck = scratch_path(spark, "revenue"), scratch_path(spark, "revenue-ck")
    q = streaming.start_windowed_revenue(stream, out, ck, window="3 hours", delay=delay,
                                         trigger="availableNow")
    _drained(spark, [q], path, ck)
    return streaming.window_growth(spark.read.parquet(out))


@register("st3_churn_alerts", f"""
with g as (
  select customer_id, order_date,
         lag(order_date) over (partition by customer_id order by order_date) as prev
  from {O} o),
s as (
  select customer_id, order_date,
         sum(case when prev is null or order_date > prev + interval 7 day then 1 else 0 end)
           over (partition by customer_id order by order_date
                 rows between unbounded preceding and current row) as spell
  from g),
spells as (
  select customer_id, spell, min(order_date) as session_start,
         max(order_date) as last_ordered_date
  from s group by customer_id, spell)
select customer_id, session_start, last_ordered_date from spells
where last_ordered_date + interval 7 day <= (select max(order_date) from {O} o2)
""")
def st3_churn_alerts(spark, sf_dir):
    t = _t(spark, sf_dir)
    orders = t.raw("orders").select(F.col("o_custkey").alias("customer_id"),
                                    F.col("o_orderdate").alias("order_date"))
    stream, delay, path, _ = _replay(spark, orders, "order_date")
    out, ck = scratch_path(spark, "churn"), scratch_path(spark, "churn-ck")
    q = streaming.start_churn_alerts(stream, out, ck, min_days=7, delay=delay,
                                     trigger="availableNow")
    _drained(spark, [q], path, ck)
    return spark.read.parquet(out)


# -- the batch job and its streaming refresh, read back from their outputs ------



# The stored customers have no signup times: the first signup event of the
# same id, moved back so that the events end when the orders do.
_SHIFT_DAYS = (dt.datetime.fromisoformat(EVENTS_AS_OF) - dt.datetime.fromisoformat(ORDERS_AS_OF)).days
_SIGNED = f"""(select c.customer_id, e.signup_date - interval {_SHIFT_DAYS} day as signup_date
    from {C} c left join {EC} e on c.customer_id = e.customer_id)"""


def _relations(spark, sf_dir) -> Relations:
    t = _t(spark, sf_dir)
    signed = t.event_customers().select("customer_id", (
        F.col("signup_date") - F.expr(f"INTERVAL {_SHIFT_DAYS} DAYS")).alias("signup_date"))
    customers = t.customers().drop("signup_date").join(signed, "customer_id", "left").select(t.customers().columns)
    return Relations(customers, t.products(), t.orders(), t.order_items())


# every output of the job as (output, a, b, x, y) rows: its text and time
# columns in a and b, its numbers in x and y
_OUTPUT_COLUMNS = {
    "customer_ltv": ("customer_id || '|' || name", "window_start", "customer_ltv", "rank"),
    "regional_revenue": ("location", None, "total_revenue", None),
    "membership_revenue": ("membership_type", None, "revenue_generated", None),
    "monthly_sales": (None, None, "monthly_sales", "order_month"),
    "weekday_sales": (None, None, "weekday_sales", "order_weekday"),
    "hourly_sales": (None, None, "hourly_sales", "order_hour"),
    "top_products": ("name", None, "sold_quantity", None),
    "category_revenue": ("category", None, "revenue_generated", None),
    "churn_risk": ("customer_id", "last_ordered_date", "days_since_last_order", None),
}
_JOB_SUMMARY = {
    "total_orders_count": K01,
    "customers_in_last_3hrs": f"select count(distinct customer_id) from {_SIGNED} s where signup_date >= {OA} - interval 3 hour",
    "total_sales_amount": K03,
    "total_items_sold": K04, "total_products_sold": K05, "aov": K06, "cac": K07,
    "avg_time": K08.replace(EC, _SIGNED).replace(EO, O), "percent_repeat_customers": K09,
    "sales_in_last3hrs": f"select coalesce(sum(total_amount), 0) from {O} o where order_date >= {OA} - interval 3 hour",
    "growth_rate": K11.replace(EO, O).replace(EA, OA), "inventory_turnover": K12,
}


def _tagged(name: str) -> str:
    a, b, x, y = (c or "null" for c in _OUTPUT_COLUMNS[name])
    return (f"select '{name}' as output, cast({a} as string) as a, cast({b} as string) as b, "
            f"cast({x} as double) as x, cast({y} as double) as y")


def _outputs_sql(names) -> str:
    oracles = {k.split("_", 1)[1]: v for k, v in ORACLES.items() if k[0] == "t"}
    oracles["hourly_sales"] = f"""select hour(order_date)::int as order_hour,
        sum(total_amount)::double as hourly_sales from {O} o group by 1"""  # t06 reads the events
    parts = [f"{_tagged(n)} from ({oracles[n]}) q" for n in names]
    parts += [f"select 'summary_kpis', '{k}', null, cast(({v}) as double), null"
              for k, v in _JOB_SUMMARY.items()]
    return " union all ".join(parts).replace("as string)", "as varchar)")


def _outputs(spark, written: dict[str, str], frames: dict[str, DataFrame]) -> DataFrame:
    """What was written, read back and tagged."""
    out = None
    for name in _OUTPUT_COLUMNS:
        back = src_results.read_result(spark, written[name], frames[name].schema)
        part = back.selectExpr(*[c for c in _tagged(name)[len("select "):].split(", ")])
        out = part if out is None else out.unionByName(part)
    summary = src_results.read_summary(spark, written["summary_kpis"])
    for k in _JOB_SUMMARY:
        out = out.unionByName(summary.selectExpr(
            "'summary_kpis' as output", f"'{k}' as a", "cast(null as string) as b",
            f"cast({k} as double) as x", "cast(null as double) as y"))
    return out


@register("s05_batch_job_outputs", _outputs_sql(_OUTPUT_COLUMNS))
def s05_batch_job_outputs(spark, sf_dir):
    """All ten outputs of the batch job, written and read back."""
    out, rel = scratch_path(spark, "job"), _relations(spark, sf_dir)
    params = dict(as_of=ORDERS_AS_OF, top_lookback=TOP_PRODUCTS_LOOKBACK)
    written = run_batch(rel, out, **params)
    return _outputs(spark, written, kpi_outputs(rel, **params))


def _maintained(spark, sf_dir):
    """Pre-aggregates maintained from orders and items that arrive in several
    micro-batches, compacted halfway: (root, checkpoints)."""
    t = _t(spark, sf_dir)
    root, ck = scratch_path(spark, "pre-aggregates"), scratch_path(spark, "pre-aggregates-ck")
    folders = []
    streams = {}
    items = t.order_items()
    for name, df, time in (("orders", t.orders(), "order_date"), ("order_items", items, None)):
        sent = df.withColumn(ROW_HASH, F.xxhash64("order_id", "product_id" if time is None else "customer_id"))
        if time is None:        # items carry no time: they arrive in slices of their ids
            at = F.timestamp_seconds(F.pmod("order_id", F.lit(FEW_SLICES))).cast("timestamp_ntz")
            path, files, _ = _arriving(spark, sent.withColumn("_at", at), "_at")
        else:
            path, files, _ = _arriving(spark, sent, time)
        folders.append(path)
        streams[name] = _stream(spark, items if time is None else df, path, files)
    for q in incremental.start_partials(streams["orders"], streams["order_items"], root, ck,
                                        trigger="availableNow"):
        q.awaitTermination()
    for name in incremental.AGGREGATES:
        incremental.compact(spark, root, name)
    for path in (*folders, ck):
        remove_path(spark, path)
    return root


@register("st5_refresh_outputs", _outputs_sql(_OUTPUT_COLUMNS))
def st5_refresh_outputs(spark, sf_dir):
    """A stream over the orders paces the refresh, which derives the outputs
    from the maintained pre-aggregates; all ten are read back."""
    t, rel = _t(spark, sf_dir), _relations(spark, sf_dir)
    root = _maintained(spark, sf_dir)
    pacer = spark.readStream.schema(t.raw("orders").schema).parquet(t.stream_path("orders"))
    out, ck = scratch_path(spark, "refresh"), scratch_path(spark, "refresh-ck")
    params = dict(as_of=ORDERS_AS_OF, top_lookback=TOP_PRODUCTS_LOOKBACK)
    q = streaming.start_refresh(pacer, lambda: rel, out, ck, trigger="availableNow",
                                pre_aggregates_root=root, **params)
    q.awaitTermination()
    for path in (root, ck):
        remove_path(spark, path)
    frames = kpi_outputs(rel, **params)
    return _outputs(spark, {name: f"{out}/{name}" for name in frames}, frames)


@register("st5_incremental_ltv", ORACLES["t01_customer_ltv"])
def st5_incremental_ltv(spark, sf_dir):
    """The LTV table from the maintained per-(window, customer) aggregate
    instead of the order history."""
    t, root = _t(spark, sf_dir), _maintained(spark, sf_dir)
    return tables.customer_ltv(t.orders(), t.customers(),
                               per_window=incremental.current(spark, root, "per_window"))


from salestide.plans import maintained  # noqa: E402,F401  registers the queries over maintained tables
