"""Bind the driver's stored tables to the canonical relations.

TPC-H-style tables stand in for the sales model (see SURVEY §2.14):

* orders      <- orders (o_orderkey, o_custkey, o_orderdate, o_totalprice,
                 o_orderstatus as channel, o_orderpriority as payment method)
* customers   <- customer + nation (n_name is the location,
                 c_mktsegment the membership type)
* products    <- part (p_type is the category)
* order_items <- lineitem (l_extendedprice is the exact line amount)
* events      <- hour-grain stand-ins: 'purchase' events are orders with
                 sub-second times, 'signup' events are customer signups.

Ids stay bigint (the operators never assume a type for ids).  Every binding
is a lazy projection, so Catalyst prunes unused columns and pushes filters
into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide.functions.money import to_money

# As-of instants of the stored data (fixed values): orders end on
# 2001-08-01, events on 2024-01-30.
ORDERS_AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"

def _null_str():
    return F.lit(None).cast("string")


def bind_orders(raw: DataFrame) -> DataFrame:
    """``orders`` table (batch or stream) -> canonical orders."""
    return raw.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
        to_money("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("sales_channel"),
        F.col("o_orderpriority").alias("payment_method"))


def bind_order_items(raw: DataFrame) -> DataFrame:
    """``lineitem`` table (batch or stream) -> canonical order items."""
    amount = to_money("l_extendedprice")
    qty = F.col("l_quantity").cast("int")
    return raw.select(
        _null_str().alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        qty.alias("quantity"),
        to_money(F.try_divide(amount, qty)).alias("unit_price"),
        amount.alias("line_amount"))


class StoredTables:
    """Canonical views over ``<sf_dir>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        # one relation per table and query: its bindings share one listing
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    def stream_path(self, name: str) -> str:
        """The table as a pattern (a streaming file source takes no single
        file as a path) that matches this one name only."""
        return f"{self.sf_dir}/{name}.parque[t]"

    # -- sales model -------------------------------------------------------
    def orders(self) -> DataFrame:
        return bind_orders(self.raw("orders"))

    def customers(self) -> DataFrame:
        """Customers with the nation name as location; signup times are not
        in the customer table (see ``event_customers``)."""
        nation = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("location"))
        cust = self.raw("customer").join(nation, "c_nationkey", "left")
        return cust.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            _null_str().alias("gender"), _null_str().alias("email"), _null_str().alias("phone"),
            F.lit(None).cast("timestamp_ntz").alias("signup_date"),
            F.col("location"),
            F.col("c_mktsegment").alias("membership_type"))

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_name").alias("name"),
            to_money("p_retailprice").alias("price"))

    def order_items(self) -> DataFrame:
        return bind_order_items(self.raw("lineitem"))

    def stream(self, name: str) -> DataFrame:
        """The stored table as a file-source stream (one micro-batch per file)."""
        return (self.spark.readStream.schema(self.raw(name).schema)
                .option("maxFilesPerTrigger", 1).parquet(self.stream_path(name)))

    # -- hour-grain stand-ins from events ----------------------------------
    def _events(self, kind: str) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == kind)

    def event_orders(self) -> DataFrame:
        """Purchase events as orders (sub-second order times)."""
        return self._events("purchase").select(
            F.col("event_id").alias("order_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").cast("timestamp_ntz").alias("order_date"),
            to_money("value").alias("total_amount"),
            _null_str().alias("sales_channel"),
            _null_str().alias("payment_method"))

    def signup_customers(self) -> DataFrame:
        """One customer row per signup event (a user may sign up repeatedly)."""
        return self._events("signup").select(
            F.col("user_id").alias("customer_id"),
            _null_str().alias("name"),
            F.col("ts").cast("timestamp_ntz").alias("signup_date"))

    def event_customers(self) -> DataFrame:
        """Customers from signup events, signup time = first signup."""
        return (self.signup_customers().groupBy("customer_id")
                .agg(F.min("signup_date").alias("signup_date"))
                .select("customer_id", _null_str().alias("name"), "signup_date"))
