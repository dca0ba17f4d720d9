import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from salestide import streaming
from salestide.operators import tables
from salestide.session import scratch_path
from salestide.sources.stream import MESSAGE_SCHEMA, to_messages
from tests import fixtures as fx


def _stream_of(spark, df):
    path = scratch_path(spark, "stream-src")
    df.write.json(path)
    return spark.readStream.schema(df.schema).json(path)


def test_ingest_dedup_late_and_malformed(spark):
    _c, _p, o, _i = fx.frames(spark)
    msgs = to_messages(o, "orders").unionByName(to_messages(o.limit(3), "orders"))
    junk = spark.createDataFrame([("orders", "{broken")], "topic string, value string")
    src = scratch_path(spark, "msgs")
    msgs.unionByName(junk).write.json(src)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).json(src)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    qs = streaming.start_ingest(stream, out, ck, {"orders": "orders"}, trigger="availableNow",
                                dedup={"orders": ("order_id", "order_date", "1 day")})
    for q in qs:
        q.awaitTermination()
    got = spark.read.parquet(f"{out}/orders")
    assert got.count() == 8
    assert sorted(r.order_id for r in got.collect()) == sorted(r[0] for r in fx.ORDERS)

    # a second run on the same checkpoint, with one duplicate and one row far
    # behind the watermark, adds nothing and keeps exactly-once output
    late = spark.createDataFrame(
        [("orders", '{"order_id": "O1", "customer_id": "C1", "order_date": '
                    '"2025-05-01T12:00:00", "total_amount": 50.5}')],
        "topic string, value string")
    late.write.mode("append").json(src)
    qs = streaming.start_ingest(spark.readStream.schema(MESSAGE_SCHEMA).json(src), out, ck,
                                {"orders": "orders"}, trigger="availableNow",
                                dedup={"orders": ("order_id", "order_date", "1 day")})
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(f"{out}/orders").count() == 8


def test_ingest_with_one_source_per_topic(spark):
    c, _p, o, _i = fx.frames(spark)
    srcs = {}
    for topic, df in (("t-orders", o), ("t-customers", c)):
        srcs[topic] = scratch_path(spark, "per-topic")
        to_messages(df, topic).write.json(srcs[topic])
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    qs = streaming.start_ingest(
        lambda t: spark.readStream.schema(MESSAGE_SCHEMA).json(srcs[t]), out, ck,
        {"t-orders": "orders", "t-customers": "customers"}, trigger="availableNow")
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(f"{out}/orders").count() == 8
    assert spark.read.parquet(f"{out}/customers").count() == 4


def test_items_keep_broker_time_for_windowed_top_n(spark):
    _c, p, _o, i = fx.frames(spark)
    # items of O1-O3 were published on 05-07, the rest on 05-09
    broker_time = F.when(F.col("order_id").isin("O1", "O2", "O3"),
                         F.lit("2025-05-07 10:00:00")).otherwise(F.lit("2025-05-09 00:00:00"))
    fields = [F.col(c) for c in i.drop("line_amount").columns]
    msgs = i.select(F.lit("items").alias("topic"), F.to_json(F.struct(*fields)).alias("value"),
                    broker_time.cast("timestamp").alias("timestamp"))
    src = scratch_path(spark, "items-msgs")
    msgs.write.json(src)
    schema = "topic string, value string, timestamp timestamp"
    out, ck = scratch_path(spark, "items-out"), scratch_path(spark, "items-ck")
    for q in streaming.start_ingest(spark.readStream.schema(schema).json(src), out, ck,
                                    {"items": "order_items"}, trigger="availableNow",
                                    keep=("timestamp",)):
        q.awaitTermination()
    table = spark.read.parquet(f"{out}/order_items")
    assert "timestamp" in table.columns and table.count() == 9
    top, tck = scratch_path(spark, "top"), scratch_path(spark, "top-ck")
    streaming.start_top_products(
        spark.readStream.schema(table.schema).parquet(f"{out}/order_items"), top, tck,
        event_time="timestamp", products=p, window="1 day", k=1, delay="0 seconds",
        trigger="availableNow").awaitTermination()
    rows = [(r.window_start, r.product_id, r.name, r.sold_quantity)
            for r in spark.read.parquet(top).collect()]
    # the 05-07 window is closed (P1..P4 one line each, tie broken on id);
    # the 05-09 window is still open
    assert rows == [(dt.datetime(2025, 5, 7), "P1", "Atlas", 1)]


def test_dedup_collapse_strategy(spark):
    _c, _p, o, _i = fx.frames(spark)
    hot = o.where("order_id = 'O1'")
    msgs = to_messages(o, "orders")
    for _ in range(20):  # one message redelivered many times
        msgs = msgs.unionByName(to_messages(hot, "orders"))
    src = scratch_path(spark, "msgs")
    msgs.write.json(src)
    out, ck = scratch_path(spark, "out"), scratch_path(spark, "ck")
    qs = streaming.start_ingest(spark.readStream.schema(MESSAGE_SCHEMA).json(src), out, ck,
                                {"orders": "orders"}, trigger="availableNow",
                                dedup={"orders": ("order_id", "order_date", "0 seconds",
                                                  "collapse")})
    for q in qs:
        q.awaitTermination()
    got = spark.read.parquet(f"{out}/orders")
    assert got.columns == o.columns
    # every order exactly once (an event time at the watermark is closed)
    ids = sorted(r.order_id for r in got.collect())
    assert ids == sorted(r[0] for r in fx.ORDERS)


def test_windowed_revenue_equals_batch_on_closed_windows(spark):
    _c, _p, o, _i = fx.frames(spark)
    stream = _stream_of(spark, o)
    out, ck = scratch_path(spark, "rev"), scratch_path(spark, "rev-ck")
    streaming.start_windowed_revenue(stream, out, ck, window="1 hour",
                                     trigger="availableNow").awaitTermination()
    got = {r.window_start: r.sales for r in spark.read.parquet(out).collect()}
    # batch: every window that ends at or before the last event time
    last = max(r[2] for r in fx.ORDERS)
    want = {}
    for r in fx.ORDERS:
        start = r[2].replace(minute=0, second=0, microsecond=0)
        if start + dt.timedelta(hours=1) <= last:
            want[start] = want.get(start, D(0)) + r[3]
    assert got == want
    growth = {r.window_start: r.growth_pct
              for r in streaming.window_growth(spark.read.parquet(out)).collect()}
    assert growth[dt.datetime(2025, 5, 8, 1)] == pytest.approx((45.75 - 30.50) / 30.50 * 100)
    assert growth[dt.datetime(2025, 5, 1, 12)] is None


def test_top_products_stream_ranks_closed_windows(spark):
    _c, p, o, i = fx.frames(spark)
    timed = i.join(o.select("order_id", "order_date"), "order_id")
    out, ck = scratch_path(spark, "tp"), scratch_path(spark, "tp-ck")
    streaming.start_top_products(_stream_of(spark, timed), out, ck, event_time="order_date",
                                 products=p, window="1 day", k=1, delay="0 seconds",
                                 trigger="availableNow").awaitTermination()
    rows = {r.window_start.date(): (r.product_id, r.name, r.sold_quantity)
            for r in spark.read.parquet(out).collect()}
    # 05-08: P5 twice (O4, O5), P4 once, P1 once; the 05-12 window is still open
    assert rows[dt.date(2025, 5, 8)] == ("P5", "Rug", 2)
    assert dt.date(2025, 5, 12) not in rows


def test_churn_alerts_one_per_idle_spell(spark):
    _c, _p, o, _i = fx.frames(spark)
    out, ck = scratch_path(spark, "churn"), scratch_path(spark, "churn-ck")
    streaming.start_churn_alerts(_stream_of(spark, o), out, ck, min_days=3,
                                 trigger="availableNow").awaitTermination()
    got = sorted((r.customer_id, r.session_start, r.last_ordered_date)
                 for r in spark.read.parquet(out).collect())
    # watermark = last event (05-12 08:00); a spell ends 3 days after its last
    # order.  C4 went idle after 05-08 and came back on 05-12 (still open).
    assert got == [
        ("C1", fx.ts("2025-05-01 12:00:00"), fx.ts("2025-05-03 09:15:00")),
        ("C2", fx.ts("2025-05-07 23:00:00"), fx.ts("2025-05-08 02:55:00")),
        ("C3", fx.ts("2025-05-08 00:59:59.900000"), fx.ts("2025-05-08 01:50:00")),
        ("C4", fx.ts("2025-05-08 02:10:00"), fx.ts("2025-05-08 02:10:00")),
    ]
    # the spells still idle at the end are the batch churn list
    batch = {r.customer_id for r in
             tables.churn_risk(o, as_of="2025-05-12 08:00:00", min_days=4).collect()}
    assert batch == {"C1", "C2", "C3"}


def test_refresh_writes_outputs(spark):
    from salestide.plans.job import Relations
    c, p, o, i = fx.frames(spark)
    out, ck = scratch_path(spark, "refresh"), scratch_path(spark, "refresh-ck")
    q = streaming.start_refresh(_stream_of(spark, o), lambda: Relations(c, p, o, i), out, ck,
                                as_of=fx.AS_OF, trigger="availableNow")
    q.awaitTermination()
    summary = spark.read.option("header", True).csv(f"{out}/summary_kpis").collect()
    assert summary[0]["total_orders_count"] == "8"


def _shuffled(spark, df, files, time, end=None):
    """``df`` dealt over files out of time order, read one per micro-batch; an
    optional last row moves the watermark."""
    path = scratch_path(spark, "shuffled")
    rows = sorted(df.collect(), key=lambda r: hash(str(r[0])[::-1]))
    for n in range(files):
        spark.createDataFrame(rows[n::files], df.schema).coalesce(1).write.json(f"{path}/part-{n}")
    if end:
        row = {f.name: None for f in df.schema} | {time: fx.ts(end)}
        spark.createDataFrame([tuple(row[f.name] for f in df.schema)], df.schema).write.json(f"{path}/part-z")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).json(f"{path}/part-*")


def test_results_do_not_depend_on_micro_batching(spark):
    _c, _p, o, _i = fx.frames(spark)

    def run(files):
        churn, rev = scratch_path(spark, "c"), scratch_path(spark, "r")
        out = []
        for start, path, kw in ((streaming.start_churn_alerts, churn, {"min_days": 2}),
                                (streaming.start_windowed_revenue, rev, {"window": "1 day"})):
            q = start(_shuffled(spark, o, files, "order_date", "2025-06-11 08:00:00"), path,
                      scratch_path(spark, "ck"), delay="30 days", trigger="availableNow", **kw)
            q.awaitTermination()
            assert streaming.late_rows(q) == 0
            out.append(sorted(map(tuple, spark.read.parquet(path).collect())))
        return out

    one, many = run(1), run(4)
    assert one == many
    assert len(one[0]) >= 3 and len(one[1]) >= 4


def test_dedup_of_shuffled_micro_batches(spark):
    _c, _p, o, _i = fx.frames(spark)
    for strategy in ("first_seen", "collapse"):
        out = scratch_path(spark, "dd")
        stream = _shuffled(spark, o.unionAll(o), 4, "order_date", "2025-06-11 08:00:00")
        q = (streaming.dedupe(stream, "order_id", "order_date", "30 days", strategy)
             .writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", scratch_path(spark, "ck")).trigger(availableNow=True).start())
        q.awaitTermination()
        got = [r.order_id for r in spark.read.parquet(out).collect() if r.order_id]
        assert sorted(got) == sorted(r[0] for r in fx.ORDERS)


def test_rows_beyond_the_delay_are_counted(spark):
    _c, _p, o, _i = fx.frames(spark)
    path = scratch_path(spark, "late")
    new, old = "order_date >= '2025-05-12'", "order_date < '2025-05-12'"
    for n, cond in enumerate((new, new, old)):  # a batch drops by the watermark of the batch before
        o.where(cond).coalesce(1).write.json(f"{path}/p{n}")
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).json(f"{path}/p*")
    q = streaming.start_windowed_revenue(stream, scratch_path(spark, "o"), scratch_path(spark, "ck"),
                                         window="1 hour", delay="0 seconds", trigger="availableNow")
    q.awaitTermination()
    assert streaming.late_rows(q) > 0


def test_event_time_survives_daylight_saving_gaps(spark):
    from salestide.streaming.common import as_instant, as_wall_clock
    times = ["2024-03-10 02:30:00.123456", "2024-11-03 01:30:00", "1969-12-31 23:59:58.5", None]
    df = spark.createDataFrame([(t,) for t in times], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = df.select("t", as_wall_clock(as_instant(F.col("t"))).alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert all(r.t == r.back for r in rows)


def test_quarantine_holds_what_does_not_decode(spark):
    src = scratch_path(spark, "msgs")
    values = ['{"order_id": "a", "order_date": "2031-02-03T04:05:06", "total_amount": 1.5}',
              '{"order_id": "b", "total_amount": "abc"}', "{broken"]
    spark.createDataFrame([("t", v) for v in values], "topic string, value string").write.json(src)
    out = scratch_path(spark, "out")
    for q in streaming.start_ingest(spark.readStream.schema(MESSAGE_SCHEMA).json(src), out,
                                    scratch_path(spark, "ck"), {"t": "orders"}, trigger="availableNow",
                                    quarantine=True):
        q.awaitTermination()
    assert [r.order_id for r in spark.read.parquet(f"{out}/orders").collect()] == ["a"]
    assert spark.read.json(f"{out}/_rejected/orders").count() == 2


def test_window_growth_keeps_windows_without_amounts(spark):
    day = [dt.datetime(2031, 1, d) for d in (1, 2, 3)]
    rows = [(day[0], day[1], D("2.00")), (day[1], day[2], None)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, sales decimal(18,2)")
    got = {r.window_start: r for r in streaming.window_growth(df).collect()}
    assert set(got) == {day[0], day[1]}
    assert got[day[1]].sales is None and got[day[1]].prev_sales == 2.0


def test_items_joined_to_order_time_in_stream(spark):
    _c, p, o, i = fx.frames(spark)
    # item messages carry only a broker time, a few seconds after the order
    timed = i.join(o.select("order_id", "order_date"), "order_id").select(
        *[F.col(c) for c in i.columns],
        (F.col("order_date") + F.expr("INTERVAL 3 SECONDS")).cast("timestamp").alias("timestamp"))
    orders_stream = _stream_of(spark, o)
    items_stream = _stream_of(spark, timed)
    enriched = streaming.items_with_order_time(orders_stream, items_stream, max_skew="1 minute",
                                               delay="0 seconds")
    top, ck = scratch_path(spark, "join-top"), scratch_path(spark, "join-ck")
    streaming.start_top_products(enriched, top, ck, event_time="order_ts", watermarked=True,
                                 products=p, window="1 day", k=1,
                                 trigger="availableNow").awaitTermination()
    rows = {r.window_start.date(): (r.product_id, r.sold_quantity)
            for r in spark.read.parquet(top).collect()}
    # same as the batch count per order day: 05-08 has P5 on two lines
    assert rows[dt.date(2025, 5, 8)] == ("P5", 2)
    assert rows[dt.date(2025, 5, 1)] == ("P1", 1)
