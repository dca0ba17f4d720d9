"""Canonical relations of the sales model, as explicit Spark schemas.

Timestamps are wall-clock times without a zone (``TIMESTAMP_NTZ``): the
producer stamps naive local times, so no session time zone may shift them.
Money is ``decimal(18,2)`` so that sums are exact; results are cast to double
only at the output edge.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("signup_date", T.TimestampNTZType()),
    T.StructField("location", T.StringType()),
    T.StructField("membership_type", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("price", MONEY),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("total_amount", MONEY),
    T.StructField("sales_channel", T.StringType()),
    T.StructField("payment_method", T.StringType()),
])

ORDER_ITEMS = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
])

# relation name -> (schema, id column).  The id column also detects header
# lines repeated inside a CSV file: on such a row it holds its own name.
RELATIONS = {
    "customers": (CUSTOMERS, "customer_id"),
    "products": (PRODUCTS, "product_id"),
    "orders": (ORDERS, "order_id"),
    "order_items": (ORDER_ITEMS, "item_id"),
}

# The summary the batch job writes: fixed values, the original job's header names.
SUMMARY = T.StructType([
    T.StructField("total_orders_count", T.LongType()),
    T.StructField("customers_in_last_3hrs", T.LongType()),
    T.StructField("total_sales_amount", T.DoubleType()),
    T.StructField("total_items_sold", T.LongType()),
    T.StructField("total_products_sold", T.LongType()),
    T.StructField("aov", T.DoubleType()),
    T.StructField("cac", T.DoubleType()),
    T.StructField("avg_time", T.DoubleType()),
    T.StructField("percent_repeat_customers", T.DoubleType()),
    T.StructField("sales_in_last3hrs", T.DoubleType()),
    T.StructField("growth_rate", T.DoubleType()),
    T.StructField("inventory_turnover", T.DoubleType()),
])
