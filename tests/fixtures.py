"""Hand-made closed fixtures in the canonical schemas (string ids)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from salestide import schemas


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


CUSTOMERS = [
    # id, name, gender, email, phone, signup, location, membership
    ("C1", "Ann", "female", "a@x", "555", ts("2025-05-01 10:00:00"), "Town A", "Gold"),
    ("C2", "Bob", "male", "b@x", "555x1", ts("2025-05-07 22:30:00"), "Town B", "Silver"),
    ("C3", "Cid", "male", "c@x", "556", ts("2025-05-08 00:30:00.250000"), "Town A", "Bronze"),
    ("C4", "Dee", "female", "d@x", "557", ts("2025-05-08 01:00:00"), "Town C", "Gold"),
]
PRODUCTS = [
    ("P1", "Books", "Atlas", D("10.00")),
    ("P2", "Books", "Novel", D("20.50")),
    ("P3", "Home", "Lamp", D("99.99")),
    ("P4", "Home", "Rug", D("45.00")),
    ("P5", "Clothing", "Rug", D("15.25")),  # shares a name with P4
]
ORDERS = [
    # id, customer, time, total, channel, payment
    ("O1", "C1", ts("2025-05-01 12:00:00"), D("50.50"), "Online", "UPI"),
    ("O2", "C1", ts("2025-05-03 09:15:00"), D("99.99"), "In-store", "Card"),
    ("O3", "C2", ts("2025-05-07 23:00:00"), D("90.00"), "Online", "Card"),
    ("O4", "C3", ts("2025-05-08 00:59:59.900000"), D("30.50"), "Online", "UPI"),
    ("O5", "C3", ts("2025-05-08 01:50:00"), D("45.75"), "Online", "Cash"),
    ("O6", "C4", ts("2025-05-08 02:10:00"), D("135.00"), "In-store", "Cash"),
    ("O7", "C2", ts("2025-05-08 02:55:00"), D("20.00"), "Online", "UPI"),
    ("O8", "C4", ts("2025-05-12 08:00:00"), D("199.98"), "Online", "Card"),
]
ITEMS = [
    # id, order, product, quantity, unit price
    ("I1", "O1", "P1", 3, D("10.00")),
    ("I2", "O1", "P2", 1, D("20.50")),
    ("I3", "O2", "P3", 1, D("99.99")),
    ("I4", "O3", "P4", 2, D("45.00")),
    ("I5", "O4", "P5", 2, D("15.25")),
    ("I6", "O5", "P5", 3, D("15.25")),
    ("I7", "O6", "P4", 3, D("45.00")),
    ("I8", "O7", "P1", 2, D("10.00")),
    ("I9", "O8", "P3", 2, D("99.99")),
]
AS_OF = "2025-05-08 03:00:00"


def frames(spark, customers=CUSTOMERS, products=PRODUCTS, orders=ORDERS, items=ITEMS):
    from pyspark.sql import functions as F
    c = spark.createDataFrame(customers, schemas.CUSTOMERS)
    p = spark.createDataFrame(products, schemas.PRODUCTS)
    o = spark.createDataFrame(orders, schemas.ORDERS)
    i = spark.createDataFrame(items, schemas.ORDER_ITEMS)
    i = i.withColumn("line_amount", F.col("quantity") * F.col("unit_price"))
    return c, p, o, i
