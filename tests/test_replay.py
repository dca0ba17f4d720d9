"""Replays of stored tables: whole slices at a time, each row written once."""

import collections
import datetime as dt

import pytest
from pyspark.sql import functions as F

from salestide import streaming
from salestide.plans import catalog, maintained
from salestide.streaming import late

START = dt.datetime(2025, 5, 1)


def stored_orders(spark, folder, n=3000):
    rows = [(i, i % 40, "O", float(i % 97) + 0.25, START + dt.timedelta(minutes=(i * 7919) % 40_000), "1-URGENT")
            for i in range(n)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                "o_orderdate timestamp_ntz, o_orderpriority string") \
        .write.parquet(f"{folder}/orders.parquet")
    return rows


def stored_items(spark, folder, n=3000):
    rows = [(i // 4, i % 30, i % 3, i % 4, float(1 + i % 5), 10.5, START + dt.timedelta(days=(i * 7919) % 700))
            for i in range(n)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz") \
        .write.parquet(f"{folder}/lineitem.parquet")
    spark.range(30).select(F.col("id").alias("p_partkey"), F.lit("t").alias("p_type"), F.lit("n").alias("p_name"),
                           F.lit(1.5).alias("p_retailprice")).write.parquet(f"{folder}/part.parquet")
    return rows


@pytest.fixture
def several_files(monkeypatch):
    monkeypatch.setattr(catalog, "REPLAY_FILE_ROWS", 150)


def test_copies_are_repaired_where_a_batch_has_several_files(spark, tmp_path, several_files):
    rows = stored_orders(spark, tmp_path)
    got = maintained.st4_late_repair(spark, str(tmp_path)).collect()
    assert sorted((r.order_id, r.order_date) for r in got) == sorted((r[0], r[4]) for r in rows)


def test_counts_are_repaired_where_a_batch_has_several_files(spark, tmp_path, several_files):
    rows = stored_items(spark, tmp_path)
    got = maintained.st2_late_repair(spark, str(tmp_path)).collect()
    epoch, days = dt.datetime(1970, 1, 1), dt.timedelta(days=30)
    sold = collections.Counter((epoch + (r[6] - epoch) // days * days, r[1]) for r in rows)
    newest = max(r[6] for r in rows)
    want = []
    for start in {w for w, _ in sold if w + days <= newest}:
        best = sorted((-n, p) for (w, p), n in sold.items() if w == start)[:catalog.ST2_K]
        want += [(start, p, -n, k) for k, (n, p) in enumerate(best, 1)]
    assert sorted((r.window_start, r.product_id, r.sold_quantity, r["rank"]) for r in got) == sorted(want)


def test_a_landed_batch_has_the_same_number_of_files(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.range(300).select("id", (F.lit(START) + F.make_dt_interval(mins=F.col("id").cast("int"))).cast(
        "timestamp_ntz").alias("t"))
    for low in (0, 100, 299):       # the last batch is one row
        df.where(F.col("id").between(low, low + 99)).repartition(3).write.mode("append").parquet(path)
        for _ in range(3 - len(spark.read.parquet(path).inputFiles()) % 3):
            if len(spark.read.parquet(path).inputFiles()) % 3:
                df.limit(0).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3).parquet(path)
    late.start_landing(stream, out, str(tmp_path / "ck"), "t", "1 minute", trigger="availableNow",
                       files=3).awaitTermination()
    files = spark.read.parquet(f"{out}/on_time").inputFiles()
    assert collections.Counter(f.split("batch_id=")[1][0] for f in files) == {"0": 3, "1": 3, "2": 3}
    assert spark.read.parquet(f"{out}/on_time").count() == 201


def test_a_replay_writes_each_row_once_in_slices_of_as_many_files(spark, monkeypatch, several_files):
    wrote = []
    scratch = catalog.scratch_path
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: wrote.append(name) or scratch(s, name))
    # almost all rows in the first of three slices, some without a time
    times = [START + dt.timedelta(seconds=i) for i in range(1500)] + [None] * 5 + [START + dt.timedelta(days=3)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "id long, t timestamp_ntz")
    path, files, _ = catalog._arriving(spark, df, "t")
    assert wrote == ["replay"] and files > 1
    there = spark.read.parquet(path)
    assert sorted(map(tuple, there.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert len(there.inputFiles()) == files * (catalog.FEW_SLICES + 1)


def test_items_come_once_where_slices_are_uneven(spark, tmp_path, several_files):
    rows = [(i, i % 30, 1, 1, 2.0, 10.5, START + dt.timedelta(days=(700 if i == 2999 else i % 40)))
            for i in range(3000)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    got = catalog.st4_dedup_items(spark, str(tmp_path)).collect()
    assert sorted(r.order_id for r in got) == list(range(3000))


def test_a_row_as_old_as_the_watermark_is_landed_late(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id long, t timestamp_ntz"
    first, exact = START + dt.timedelta(minutes=100), START + dt.timedelta(minutes=99)
    for rows in ([(1, first)], [(2, exact), (3, first)], [(2, exact), (4, first)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    late.start_landing(stream, out, str(tmp_path / "ck"), "t", "1 minute", trigger="availableNow",
                       files=1).awaitTermination()
    aside = late.late(spark, out, stream.schema)
    assert [r.id for r in aside.collect()] == [2, 2]
    once = streaming.dedupe(late.on_time(spark, out, stream.schema, 1), "id", "t", "1 minute")
    q = (once.writeStream.format("parquet").option("path", str(tmp_path / "once"))
         .option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert streaming.late_rows(q) == 0
    whole = late.repair_copies(spark.read.parquet(str(tmp_path / "once")), aside, "id", "t")
    assert sorted(r.id for r in whole.collect()) == [1, 2, 3, 4]


def sold_in_days(spark, tmp_path, batches, **options):
    """start_top_products over (product, quantity, hour) rows, a file a
    micro-batch: (query, [(day, product, sold, rank)], checkpoint)."""
    path, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    schema = "product_id long, quantity int, t timestamp_ntz"
    for rows in batches:
        spark.createDataFrame([(p, q, None if h is None else START + dt.timedelta(hours=h)) for p, q, h in rows],
                              schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = streaming.start_top_products(stream, out, ck, "t", window="1 day", delay="0 seconds", trigger="availableNow",
                                     **options)
    q.awaitTermination()
    got = [((r.window_start - START).days, r.product_id, r.sold_quantity, r["rank"])
           for r in spark.read.parquet(out).collect() if r.window_end - r.window_start == dt.timedelta(days=1)]
    return q, sorted(got, key=lambda r: (r[0], r[3])), tmp_path / "ck"


def test_state_of_top_products_holds_windows_not_products(spark, tmp_path):
    # a product a row, but one that comes twice; days 0 and 1 in the first batch, 1 and 2 in the second
    first = [(p, 1, p % 48) for p in range(2000)] + [(5, 1, 7)]
    second = [(p, 1, 24 + p % 48) for p in range(2000)] + [(None, None, 70), (7, 1, None)]
    q, got, ck = sold_in_days(spark, tmp_path, [first, second, [(1, 1, 72)]], k=2)
    assert got == [(0, 5, 2, 1), (0, 0, 1, 2), (1, 0, 1, 1), (1, 1, 1, 2), (2, 24, 1, 1), (2, 25, 1, 2)]
    assert max(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]) <= 4
    assert streaming.late_rows(q) == 0
    # the rows of the first batch are gone once days 0 and 1 have closed
    assert sorted(f.name for f in (ck / "open_rows").iterdir()) == ["batch_id=1", "batch_id=2", "batch_id=3"]


def test_top_products_leave_out_and_count_late_rows(spark, tmp_path):
    # in the last batch, days 0 (closed before) and 2 (nothing came in time) are late
    batches = [[(1, 1, 1)], [(2, 1, 75)], [(3, 1, 80)], [(4, 5, 2), (5, 5, 50), (6, None, 90)], [(7, 1, 130)]]
    q, got, _ = sold_in_days(spark, tmp_path, batches, measure="units")
    assert got == [(0, 1, 1, 1), (3, 2, 1, 1), (3, 3, 1, 2), (3, 6, None, 3)]
    assert streaming.late_rows(q) > 0


def test_a_retried_batch_of_top_products_replaces_its_output(spark, tmp_path):
    batches = [[(p, 1, 24 * n + p) for p in range(3)] * (n + 1) for n in range(6)]
    _, got, ck = sold_in_days(spark, tmp_path, batches)
    last = max(int(f.name) for f in (ck / "commits").iterdir() if f.name.isdigit())
    for f in (f"{last}", f".{last}.crc"):       # as if the last batch had failed after its output
        (ck / "commits" / f).unlink()
    _, again, _ = sold_in_days(spark, tmp_path, [])
    assert len(got) == 15 and again == got


def test_a_stream_of_top_products_leaves_the_session_as_it_was(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        sold_in_days(spark, tmp_path, [[(1, 1, 1)], [(1, 1, 30)]])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "7"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
