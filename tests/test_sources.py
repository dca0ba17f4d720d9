import os
import tempfile

import pytest
from pyspark.sql import functions as F

from salestide.schemas import SUMMARY
from salestide.session import scratch_path
from salestide.sources import (
    decode, read_relation, read_result, read_summary, rejected, rejected_rows, route, to_messages,
    write_result,
)
from tests import fixtures as fx

ORDERS_CSV = """order_id,customer_id,order_date,total_amount,sales_channel,payment_method
first,ann,2031-02-03 04:05:06.070809,12.34,kiosk,voucher
second,ben,2031-02-04 00:00:00,56.78,phone,cash
order_id,customer_id,order_date,total_amount,sales_channel,payment_method
third,ann,2031-02-05 23:59:59.999999,9.10,phone,voucher
"""

ITEMS_CSV = """item_id,order_id,product_id,quantity,unit_price
line-a,first,kite,2,4.25
item_id,order_id,product_id,quantity,unit_price
line-b,first,drum,5,1.10
"""


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="salestide-test-")
    path = os.path.join(d, "data.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_repeated_header_rows_dropped_by_default(spark):
    path = _write(ORDERS_CSV)
    df = read_relation(spark, path, "orders")
    rows = df.orderBy("order_id").collect()
    assert [r.order_id for r in rows] == ["first", "second", "third"]
    assert rows[0].order_date.isoformat() == "2031-02-03T04:05:06.070809"
    assert str(rows[0].total_amount) == "12.34"
    # count() and a single-column projection must not resurrect the phantom
    assert df.count() == 3
    assert df.select("order_id").distinct().count() == 3


def test_repeated_header_rows_kept_in_compat_mode(spark):
    df = read_relation(spark, _write(ORDERS_CSV), "orders", keep_repeated_headers=True)
    assert df.count() == 4
    phantom = df.where(F.col("order_id") == "order_id").collect()
    assert len(phantom) == 1 and phantom[0].order_date is None


def test_items_get_line_amount(spark):
    df = read_relation(spark, _write(ITEMS_CSV), "order_items")
    amounts = sorted(str(r.line_amount) for r in df.collect())
    assert amounts == ["5.50", "8.50"]


def test_values_with_commas_survive_the_writer(spark):
    c, _p, _o, _i = fx.frames(spark, customers=[
        ("C1", "Doe, Jane", "female", "j@x", "1", fx.ts("2025-05-01 00:00:00"),
         "Port, East", "Gold")])
    path = scratch_path(spark, "commas")
    write_result(c, path)
    back = read_relation(spark, path, "customers").collect()
    assert back[0].name == "Doe, Jane" and back[0].location == "Port, East"


def test_result_reader_missing_and_present(spark):
    missing = scratch_path(spark, "missing")
    schema = "category string, revenue_generated double"
    assert read_result(spark, missing, spark.createDataFrame([], schema).schema).count() == 0
    zeros = read_summary(spark, missing).collect()
    assert len(zeros) == 1 and all(v == 0 for v in zeros[0])
    df = spark.createDataFrame([("A", 1.5)], schema)
    path = scratch_path(spark, "present")
    write_result(df, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    assert read_result(spark, path, df.schema).collect()[0].revenue_generated == 1.5


def test_summary_reader_keeps_fractions(spark):
    row = tuple([5, 1, 10.5, 3, 2, 2.1, 3.3, 0.646, 31.29, 1.0, float("inf"), 736.2])
    df = spark.createDataFrame([row], SUMMARY)
    path = scratch_path(spark, "summary")
    write_result(df, path, single_file=True)
    got = read_summary(spark, path).collect()[0]
    assert got.avg_time == 0.646 and got.inventory_turnover == 736.2
    assert got.growth_rate == float("inf")


def test_json_decode_and_route(spark):
    c, p, o, _i = fx.frames(spark)
    msgs = to_messages(o, "t-orders").unionByName(to_messages(p, "t-products"))
    bad = spark.createDataFrame([("t-orders", "{not json"), ("t-orders", '{"x": 1}')],
                                "topic string, value string")
    routed = route(msgs.unionByName(bad), {"t-orders": "orders", "t-products": "products"})
    assert routed["orders"].count() == 8  # malformed and foreign-shaped values dropped
    assert routed["products"].count() == 5
    back = {r.order_id: (r.order_date, r.total_amount) for r in routed["orders"].collect()}
    assert back["O4"] == (fx.ts("2025-05-08 00:59:59.900000"), fx.D("30.50"))


def test_decode_producer_style_json(spark):
    # field order and number formats as a Python producer emits them
    value = ('{"customer_id": "zed", "name": "Zed Zulu", "gender": "other", "email": "zed@z.test", '
             '"phone": "+00 12-34", "signup_date": "2031-02-03 04:05:06.070809", '
             '"location": "Nowhere", "membership_type": "Trial"}')
    df = spark.createDataFrame([("c", value)], "topic string, value string")
    r = decode(df, "customers").collect()[0]
    assert r.phone == "+00 12-34"
    assert r.signup_date == fx.ts("2031-02-03 04:05:06.070809")


def test_columns_bind_by_header_name(spark):
    path = _write("price,extra,name,product_id\n1.50,zzz,Kite,kite\n2.50,zzz,Drum,drum\n")
    rows = read_relation(spark, path, "products").orderBy("product_id").collect()
    assert [(r.product_id, r.name, str(r.price), r.category) for r in rows] == [
        ("drum", "Drum", "2.50", None), ("kite", "Kite", "1.50", None)]


def test_files_with_different_headers_raise(spark):
    d = os.path.dirname(_write("product_id,name\nkite,Kite\n"))
    with open(os.path.join(d, "other.csv"), "w") as f:
        f.write("name,product_id\nDrum,drum\n")
    with pytest.raises(Exception, match="header"):
        read_relation(spark, d, "products").collect()


def test_rows_that_do_not_parse_are_set_aside(spark):
    path = _write("product_id,name,category,price\nkite,Kite,toys,1.50\n"
                  "drum,Drum, big one,music,2.50\nfife,Fife,music,cheap\nhorn,Horn,music,\n"
                  "product_id,name,category,price\n")
    good = read_relation(spark, path, "products").orderBy("product_id").collect()
    assert [(r.product_id, r.price is None) for r in good] == [("horn", True), ("kite", False)]
    bad = {r.product_id: r.reason for r in rejected_rows(spark, path, "products").collect()}
    assert set(bad) == {"drum", "fife"}
    assert bad["fife"] == "price" and "number of fields" in bad["drum"]
    assert read_relation(spark, path, "products").select("product_id").count() == 2


def test_messages_that_do_not_decode_are_set_aside(spark):
    values = ['{"order_id": "a", "order_date": "2031-02-03 04:05:06", "total_amount": 1.5}',
              '{"order_id": "b", "order_date": "2031-02-03 04:05:06", "total_amount": "abc"}',
              '{"order_id": "c", "order_date": "soon", "total_amount": 1.5}',
              '{"total_amount": 2.5}', "{broken", None]
    msgs = spark.createDataFrame([("t", v) for v in values], "topic string, value string")
    assert [r.order_id for r in decode(msgs, "orders").collect()] == ["a"]
    bad = rejected(msgs, "orders").collect()
    assert len(bad) == 5 and {r.reason for r in bad} == {"malformed", "no order_id"}


def test_parquet_and_json_relations(spark):
    _c, _p, o, i = fx.frames(spark)
    for fmt in ("parquet", "json"):
        path = scratch_path(spark, f"orders-{fmt}")
        o.write.format(fmt).save(path)
        back = read_relation(spark, path, "orders", fmt=fmt)
        assert sorted(r.order_id for r in back.collect()) == sorted(r[0] for r in fx.ORDERS)
        assert back.schema == o.schema or fmt == "json"
    path = scratch_path(spark, "items-parquet")
    i.drop("line_amount").write.parquet(path)
    back = read_relation(spark, path, "order_items", fmt="parquet")
    assert "line_amount" in back.columns


def test_as_of_now_uses_the_session_clock(spark):
    from salestide.operators import kpis
    c, _p, o, _i = fx.frames(spark)
    # the fixture lies in the past: nothing is within the last 3 hours of now
    assert kpis.new_customers(c).collect()[0][0] == 0
    assert kpis.sales_window(o).collect()[0][0] == 0.0


def test_timestamp_format_at_the_output_edge(spark):
    from salestide.operators import tables
    _c, _p, o, _i = fx.frames(spark)
    path = scratch_path(spark, "churn-text")
    write_result(tables.churn_risk(o, as_of="2025-05-15"), path, single_file=True,
                 timestamp_format="yyyy-MM-dd HH:mm:ss")
    part = [f for f in os.listdir(path) if f.startswith("part-")][0]
    with open(os.path.join(path, part)) as f:
        lines = f.read().splitlines()
    assert lines[0] == "customer_id,last_ordered_date,days_since_last_order"
    assert lines[1] == "C1,2025-05-03 09:15:00,12"


def test_kafka_reader_options_without_connector(spark):
    """The Kafka connector jar is not on this classpath: the reader is built
    and Spark reports the missing data source (nothing else fails first)."""
    from pyspark.errors import AnalysisException
    from salestide.sources.stream import kafka_messages
    try:
        kafka_messages(spark, "localhost:9092", ["orders-topic", "items-topic"],
                       maxOffsetsPerTrigger=1000)
    except AnalysisException as e:
        assert "kafka" in str(e).lower()
    else:  # a classpath with the connector: the stream has the message shape
        pass
