"""Tables that streams maintain: trailing panes, latest versions, late rows,
idle alarms, running windows."""

import datetime as dt
import random
import time
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from salestide import streaming
from salestide.operators import kpis, tables
from salestide.session import scratch_path
from salestide.streaming import idle, late, panes, upsert

START = dt.datetime(2025, 5, 1)


def stream_in_batches(spark, df, batches):
    """``batches`` of rows as a stream of that many micro-batches."""
    path = scratch_path(spark, "batches")
    for rows in batches:
        spark.createDataFrame(rows, df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def some_orders(n=400, seed=1, days=4):
    r = random.Random(seed)
    return [(i, r.randint(1, 40), START + dt.timedelta(microseconds=r.randrange(days * 86_400_000_000)),
             D(r.randint(1, 9999)) / 100) for i in range(n)]


ORDERS = "order_id long, customer_id long, order_date timestamp_ntz, total_amount decimal(18,2)"


def paned(spark, df, name, batches):
    root, ck = scratch_path(spark, "panes"), scratch_path(spark, "panes-ck")
    panes.start_panes(stream_in_batches(spark, df, batches), name, root, ck, trigger="availableNow").awaitTermination()
    return root


def test_look_backs_equal_the_batch_kpis(spark):
    rows = some_orders() + [(9999, 1, None, D(5))]
    df = spark.createDataFrame(rows, ORDERS)
    root = paned(spark, df, "sales", [rows[k::5] for k in range(5)])
    for as_of in ("2025-05-04 12:00:00", "2025-05-03 07:11:13.123456", "2025-05-02 00:15:00", "2030-01-01 00:00:00"):
        for length in ("3 hours", "7 minutes", "2 days", "50 hours"):
            want = kpis.sales_window(df, as_of, length).first()[0]
            assert panes.sales_window(spark, root, as_of, length).first()[0] == want
            want = kpis.growth_rate(df, as_of, length).first()[0]
            assert panes.growth_rate(spark, root, as_of, length).first()[0] == want


def test_both_bounds_in_one_pane(spark):
    rows = some_orders(300, 2, 1)
    root = paned(spark, spark.createDataFrame(rows, ORDERS), "sales", [rows])
    for a, b in ((60, 200), (0, 900), (100, 900), (60, 1000), (900, 1800), (899, 1801)):
        low, high = START + dt.timedelta(seconds=a), START + dt.timedelta(seconds=b)
        got = panes.within(spark, root, "sales", panes.Span(low, high)).first()
        want = sum((r[3] for r in rows if low <= r[2] < high), D(0))
        assert (got.sales if got else None) in (want, None if want == 0 else want)


def test_a_look_back_reads_only_its_panes(spark):
    rows = some_orders(200, 3, 70)          # May to July
    root = paned(spark, spark.createDataFrame(rows, ORDERS), "sales", [rows])
    span = panes.Span(START + dt.timedelta(days=62, hours=5, minutes=7))
    whole, _ = span.whole(panes.LENGTH)
    read = panes._read(spark, f"{root}/sales/rows", span)
    assert read.count() == sum(r[2].month == 7 for r in rows) < len(rows)
    plan = panes.within(spark, root, "sales", span)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and f"GreaterThanOrEqual(pane,{whole})" in plan \
        and f"EqualTo(pane,{whole - 1})" in plan
    assert panes.expire(spark, root, "sales", dt.date(2025, 7, 2)) == 2
    assert panes.sales_window(spark, root, span.low, "0 seconds").first()[0] == pytest.approx(
        float(sum(r[3] for r in rows if r[2] >= span.low)))


def test_customers_are_counted_once_over_panes_and_edges(spark):
    rows = [(i % 7, START + dt.timedelta(minutes=11 * i)) for i in range(60)] + [(None, START), (3, None)]
    df = spark.createDataFrame(rows, "customer_id long, signup_date timestamp_ntz")
    root = paned(spark, df, "signups", [rows[::2], rows[1::2]])
    for length in ("3 hours", "100 minutes", "4 minutes"):
        want = kpis.new_customers(df, "2025-05-01 11:00:00", length).first()[0]
        assert panes.new_customers(spark, root, "2025-05-01 11:00:00", length).first()[0] == want


def test_top_products_from_panes(spark):
    r = random.Random(4)
    rows = [(i, START + dt.timedelta(minutes=r.randrange(600)), r.randint(1, 6), r.choice([1, 2, 3, None]))
            for i in range(300)]
    orders = spark.createDataFrame([x[:2] for x in rows], "order_id long, order_date timestamp_ntz")
    items = spark.createDataFrame([(x[0], x[2], x[3]) for x in rows], "order_id long, product_id long, quantity int")
    products = spark.createDataFrame([(i, f"p{i}") for i in range(1, 6)], "product_id long, name string")
    timed = spark.createDataFrame([(x[1], x[2], x[3]) for x in rows],
                                  "order_time timestamp_ntz, product_id long, quantity int")
    root = paned(spark, timed, "products", [[x[1:] for x in rows[:100]], [x[1:] for x in rows[100:]]])
    for measure in ("lines", "units"):
        want = tables.top_products(orders, items, products, "2025-05-01 10:00:00", "127 minutes", 4, measure)
        got = panes.top_products(spark, root, products, "2025-05-01 10:00:00", "127 minutes", 4, measure)
        assert got.collect() == want.collect()


def test_panes_must_fill_a_day(spark):
    with pytest.raises(ValueError):
        panes.start_panes(spark.readStream.format("rate").load(), "sales", "x", "y", length="7 hours")


VERSIONS = "customer_id long, location string, timestamp timestamp_ntz"


def test_upsert_keeps_the_newest_version(spark):
    at = lambda d: START + dt.timedelta(days=d)
    batches = [[(1, "a", at(0)), (2, "b", at(5)), (1, "a2", at(3))],
               [(1, "a1", at(1)), (2, "b", at(5)), (3, None, at(0)), (None, "x", at(1))],     # older; again; no key
               [(2, "c", at(5)), (3, "d", None)],                                             # a tie; no time
               [(4, "e", at(0))] * 50]
    df = spark.createDataFrame(batches[0], VERSIONS)
    root, ck = scratch_path(spark, "upsert"), scratch_path(spark, "upsert-ck")
    upsert.start_upsert(stream_in_batches(spark, df, batches), root, ck, "customer_id", "timestamp", buckets=4,
                        trigger="availableNow").awaitTermination()
    rows = lambda: sorted(map(tuple, upsert.latest(spark, root, df.schema).collect()))
    want = [(1, "a2", at(3)), (2, "c", at(5)), (3, None, at(0)), (4, "e", at(0))]
    assert rows() == want
    held = upsert.latest(spark, root, df.schema)
    assert upsert.vacuum(spark, root, keep_batches=1) > 0
    assert rows() == want and held.count() == 4
    assert upsert.vacuum(spark, root, keep_batches=1) == 0


def test_upsert_writes_only_touched_buckets_and_hides_an_unfinished_batch(spark):
    df = spark.createDataFrame([(i, "v0", START) for i in range(200)], VERSIONS)
    one = [(7, "v1", START + dt.timedelta(1))]
    root, ck = scratch_path(spark, "upsert"), scratch_path(spark, "upsert-ck")
    upsert.start_upsert(stream_in_batches(spark, df, [df.collect(), one]), root, ck, "customer_id", "timestamp",
                        buckets=8, trigger="availableNow").awaitTermination()
    assert dict(upsert._published(spark, root)).__len__() == 8
    assert sum(n == 1 for _, n in upsert._published(spark, root)) == 1
    # a batch that died before its log entry: its folders are not read
    df.limit(3).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{root}/data/batch_id=9")
    got = upsert.latest(spark, root, df.schema)
    assert got.count() == 200 and got.where("location = 'v1'").count() == 1


def test_empty_upsert_table(spark):
    df = spark.createDataFrame([], VERSIONS)
    assert upsert.latest(spark, scratch_path(spark, "none"), df.schema).count() == 0
    assert upsert.vacuum(spark, scratch_path(spark, "none")) == 0


def landed(spark, df, batches, time_column, delay):
    out, ck = scratch_path(spark, "landing"), scratch_path(spark, "landing-ck")
    late.start_landing(stream_in_batches(spark, df, batches), out, ck, time_column, delay,
                       trigger="availableNow").awaitTermination()
    return out


def test_landing_splits_at_the_watermark(spark):
    at = lambda h: START + dt.timedelta(hours=h)
    df = spark.createDataFrame([(1, at(0))], "id long, t timestamp_ntz")
    out = landed(spark, df, [[(1, at(0)), (2, at(10))], [(3, at(8)), (4, at(9)), (5, None), (6, at(20))], [(7, at(18))]],
                 "t", "1 hour")
    assert sorted(r.id for r in late.late(spark, out, df.schema).collect()) == [3, 7]
    assert sorted(r.id for r in spark.read.parquet(f"{out}/on_time").collect()) == [1, 2, 4, 5, 6]
    assert late.late(spark, scratch_path(spark, "none"), df.schema).count() == 0


def test_churn_repair_joins_closes_and_reopens_spells(spark):
    at = lambda d: START + dt.timedelta(days=d)
    alerts = spark.createDataFrame([(1, at(0), at(2)), (1, at(12), at(13)), (2, at(0), at(1)), (3, at(0), at(0))],
                                   "customer_id long, session_start timestamp_ntz, last_ordered_date timestamp_ntz")
    orders = "customer_id long, order_date timestamp_ntz"
    # 1: bridged; 2: kept open by a late order that meets its open spell; 4: late only; 5: still open
    late_rows = spark.createDataFrame([(1, at(7)), (2, at(8)), (2, at(15)), (4, at(3)), (4, at(10)), (5, at(29))], orders)
    on_time = spark.createDataFrame([(2, at(0)), (2, at(1)), (2, at(22)), (2, at(28)), (5, at(28)), (3, at(0))], orders)
    got = late.repair_churn(alerts, late_rows, on_time, until=F.lit(at(30)).cast("timestamp_ntz"))
    assert sorted(map(tuple, got.collect())) == [(1, at(0), at(13)), (3, at(0), at(0)), (4, at(3), at(10))]


def test_copies_repair_adds_missing_keys_once(spark):
    schema = "k long, t timestamp_ntz, v string"
    rows = spark.createDataFrame([(1, START, "a")], schema)
    more = spark.createDataFrame([(1, START, "late copy"), (2, START + dt.timedelta(1), "c"), (2, START, "b")], schema)
    assert sorted(r.v for r in late.repair_copies(rows, more, "k", "t").collect()) == ["a", "b"]


def test_trailing_revenue_takes_each_order_once_per_window(spark):
    rows = sorted(some_orders(200, 6, 1), key=lambda r: r[2])
    df = spark.createDataFrame(rows, ORDERS)
    end = [(None, None, rows[-1][2] + dt.timedelta(seconds=1), None)]
    out, ck = scratch_path(spark, "trailing"), scratch_path(spark, "trailing-ck")
    streaming.start_trailing_revenue(stream_in_batches(spark, df, [rows[:80], rows[80:], end]), out, ck, "1 hour",
                                     "15 minutes", "0 seconds", trigger="availableNow").awaitTermination()
    got = {r.window_start: (r.sales, r.orders) for r in spark.read.parquet(out).collect()}
    want, hour = {}, dt.timedelta(hours=1)
    for k in range(-3, 96):
        low = START + k * dt.timedelta(minutes=15)
        inside = [r[3] for r in rows if low <= r[2] < low + hour]
        if inside and low + hour <= rows[-1][2]:
            want[low] = (sum(inside), len(inside))
    assert got == want


def test_idle_alarm_rings_without_another_event(spark):
    """Nothing follows the last order; the alarm is due while the test waits."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    day = dt.timedelta(days=1)
    rows = [(1, now - 9 * day), (1, now - 8 * day),                                # long due
            (2, now - 7 * day + dt.timedelta(seconds=20)),                         # due in 20 seconds
            (3, now - 8 * day), (3, now - 1 * day), (None, now - 9 * day), (4, None)]  # not due
    df = spark.createDataFrame(rows, "customer_id long, order_date timestamp_ntz")
    out, ck = scratch_path(spark, "idle"), scratch_path(spark, "idle-ck")
    q = idle.start_idle_alarms(stream_in_batches(spark, df, [rows]), out, ck, 7, trigger="1 second")
    try:
        found, end = [], time.time() + 120
        while len(found) < 2 and time.time() < end:
            time.sleep(2)
            try:
                found = sorted(map(tuple, spark.read.parquet(out).collect()))
            except Exception:      # nothing written yet
                pass
    finally:
        q.stop()
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    assert found == [(1, rows[1][1]), (2, rows[2][1])]


def test_bucketed_joins_exchange_nothing(spark):
    import uuid

    from salestide.sources import bucketed
    r = random.Random(8)
    orders = [(i, START + dt.timedelta(hours=i)) for i in range(300)]
    items = [(r.randrange(300), r.randint(1, 20), r.randint(1, 4), D(i)) for i in range(900)]
    products = [(i, f"c{i % 4}", f"p{i}") for i in range(1, 18)]
    frames, kept = {}, {}
    for name, rows, schema, key in (
            ("orders", orders, "order_id long, order_date timestamp_ntz", "order_id"),
            ("items", items, "order_id long, product_id long, quantity int, line_amount decimal(18,2)", "order_id"),
            ("sold", items, "order_id long, product_id long, quantity int, line_amount decimal(18,2)", "product_id"),
            ("products", products, "product_id long, category string, name string", "product_id")):
        df = frames[name] = spark.createDataFrame(rows, schema)
        layout = bucketed.Layout(f"{name}_{uuid.uuid4().hex[:8]}", scratch_path(spark, name), key, 4, df.schema)
        stream = stream_in_batches(spark, df, [rows[k::3] for k in range(3)])
        bucketed.start_bucketed(stream, [layout], scratch_path(spark, "ck"), trigger="availableNow").awaitTermination()
        bucketed.write_batch(spark.createDataFrame(rows[0::3], schema), layout, 0)      # a retried batch
        kept[name] = bucketed.open_table(spark, layout)
        again = bucketed.compact(spark, layout, bucketed.Layout(layout.name + "_c", scratch_path(spark, name), key, 4,
                                                                df.schema))
        for got in (kept[name], again):
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
        assert len(again.inputFiles()) <= 4
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        build = lambda f: (
            f["items"].join(f["orders"], "order_id").groupBy("order_id").agg(F.sum("quantity").alias("n")),
            f["sold"].groupBy("product_id").agg(F.sum("line_amount").alias("revenue")).join(
                f["products"].select("product_id", "category"), "product_id"))
        for got, want in zip(build(kept), build(frames)):
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan
            assert "Exchange" in want._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
