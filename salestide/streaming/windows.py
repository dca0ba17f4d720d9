"""ST2/ST6: tumbling-window aggregates over order streams.

Append mode: a window is emitted once, when the watermark passes its end,
so each emitted window is final and can be ranked or compared in a
micro-batch, whatever the cutting into batches, as long as ``delay`` covers
the disorder of the rows; later ones are dropped by the watermark and counted
by ``late_rows``.  (Update mode would emit only the groups a batch changed, and
per-window ranks over partial groups would be wrong.)

The products of the open windows can be more than executors hold:
``start_top_products`` keeps the rows of open windows as files and in Spark's
state only which windows are open.
"""

from __future__ import annotations

import contextlib
import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salestide.functions.money import as_double, growth_pct
from salestide.session import remove_path
from salestide.streaming.common import (
    EVENT_TS, as_instant, as_wall_clock, set_trigger, with_event_time,
)


def windowed_product_counts(items: DataFrame, event_time: str, window: str = "5 minutes",
                            delay: str = "10 minutes", measure: str = "lines",
                            watermarked: bool = False) -> DataFrame:
    """Order lines (or units) per product per tumbling window of an item
    stream whose rows carry an event time (the order time, or the broker
    timestamp of the item message).  ``watermarked`` means ``event_time``
    already is a zone-based column with a watermark (e.g. ``order_ts`` of
    ``items_with_order_time``), which is then used as it is."""
    if watermarked:
        src, ts = items, F.col(event_time)
    else:
        src, ts = with_event_time(items, event_time, delay), F.col(EVENT_TS)
    return (src.groupBy(F.window(ts, window).alias("window"), "product_id")
            .agg(_sold(measure)))


def _sold(measure: str) -> Column:
    sold = F.count("quantity") if measure == "lines" else F.sum("quantity").cast("bigint")
    return sold.alias("sold_quantity")


def items_with_order_time(orders: DataFrame, items: DataFrame, item_time: str = "timestamp",
                          max_skew: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Item stream enriched with its order's time: a stream-stream inner
    join on ``order_id``, bounded in time (the item message's ``item_time``
    within ``max_skew`` of the order time) so both sides' join state is
    evicted by the watermarks.  Adds ``order_time`` (the order's wall-clock
    time) and ``order_ts`` (the same as a watermarked instant, the event
    time to count products by: ``start_top_products(...,
    event_time="order_ts", watermarked=True)``)."""
    o = (orders.select(F.col("order_id").alias("_oid"),
                       F.col("order_date").alias("order_time"))
         .withColumn("_o_ts", as_instant(F.col("order_time")))
         .withWatermark("_o_ts", delay))
    src = items.schema[item_time].dataType
    i_ts = as_instant(F.col(item_time)) if isinstance(src, T.TimestampNTZType) \
        else F.col(item_time).cast("timestamp")
    i = items.withColumn("_i_ts", i_ts).withWatermark("_i_ts", delay)
    skew = F.expr(f"INTERVAL {max_skew}")
    cond = ((i["order_id"] == o["_oid"])
            & (i["_i_ts"] >= o["_o_ts"] - skew) & (i["_i_ts"] <= o["_o_ts"] + skew))
    return (i.join(o, cond).withColumnRenamed("_o_ts", "order_ts")
            .drop("_oid", "_i_ts"))


def rank_windows(counts: DataFrame, products: DataFrame | None = None, k: int = 10) -> DataFrame:
    """Top k products per window of a (batch) frame of closed windows.
    Columns: window_start, window_end, product_id, [name,] sold_quantity, rank."""
    return rank_counts(counts.select(as_wall_clock(F.col("window.start")).alias("window_start"),
                                     as_wall_clock(F.col("window.end")).alias("window_end"),
                                     "product_id", "sold_quantity"), products, k)


def rank_counts(counts: DataFrame, products: DataFrame | None = None, k: int = 10) -> DataFrame:
    """``rank_windows`` over counts that already carry the window's bounds."""
    order = Window.partitionBy("window_start").orderBy(
        F.col("sold_quantity").desc(), F.col("product_id"))
    top = (counts.withColumn("rank", F.row_number().over(order))
           .filter(F.col("rank") <= k)
           .withColumn("rank", F.col("rank").cast("int")))
    return with_names(top, products)


def with_names(top: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """``top`` with the products' names; as it is without ``products``."""
    if products is None:
        return top
    names = products.select("product_id", "name").join(
        top.select("product_id").distinct(), "product_id")
    return top.join(names, "product_id", "left").select(
        "window_start", "window_end", "product_id", "name", "sold_quantity", "rank")


def _idempotent_batch_writer(path: str, transform):
    """foreachBatch body that writes batch N to ``path/batch_id=N`` with
    overwrite, so a retried batch replaces its own output instead of
    appending a second copy.  The batch (the windows closed by this
    trigger) is persisted while the transform reads it twice, so the
    stateful part of the micro-batch is computed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            transform(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return write


OPEN_ROWS = "open_rows"     # in the checkpoint: the rows of windows that may be open, by micro-batch
TOP_ROWS = "top_rows"       # in the checkpoint: the last micro-batch's ranked rows, before they get names
_CLOSED = "_closed"
STATE_TASKS = 4             # for a state of one row an open window
_STARTING = threading.Lock()


@contextlib.contextmanager
def _state_tasks(spark: SparkSession, n: int):
    """A stream started here has at most ``n`` tasks with state: it goes on
    with the settings it was started with."""
    key = "spark.sql.shuffle.partitions"
    with _STARTING:
        before = spark.conf.get(key)
        spark.conf.set(key, str(min(n, int(before))))
        try:
            yield
        finally:
            spark.conf.set(key, before)


def _rows_and_closed_windows(items: DataFrame, event_time: str, window: str, delay: str) -> DataFrame:
    """The rows of an item stream (event time, product, quantity) and those
    windows that the watermark closes, as rows of their start and, in
    ``_CLOSED``, their end.  Times are in microseconds: Parquet has no
    statistics of Spark's timestamps, by which reads skip what they don't need.

    Spark's state holds a row an open window, whatever its products.  As for
    any windowed aggregate, Spark counts the rows that come too late and runs
    a last batch to close windows."""
    timed = with_event_time(items, event_time, delay)
    closed = (timed.groupBy(F.window(EVENT_TS, window).alias("window")).agg(F.count(F.lit(1)))
              .select(F.unix_micros("window.start").alias(EVENT_TS), F.unix_micros("window.end").alias(_CLOSED)))
    rows = timed.where(F.col(EVENT_TS).isNotNull()).select(
        F.unix_micros(EVENT_TS).alias(EVENT_TS), "product_id", "quantity")
    return rows.unionByName(closed, allowMissingColumns=True)


def _top_products_writer(spark: SparkSession, out_path: str, checkpoint: str, products: DataFrame | None,
                         window: str, k: int, measure: str):
    """foreachBatch body over ``_rows_and_closed_windows``: keeps the rows as
    files sorted by time, and counts and ranks the windows that close.

    A closing window takes its rows of all batches; rows that came after it
    had closed lie in no window that closes later.  Batch N is kept and
    written as ``batch_id=N`` with overwrite, so a retried batch replaces its
    own output instead of appending a second copy."""
    path = f"{checkpoint}/{OPEN_ROWS}"
    start = F.unix_micros(F.window(F.timestamp_micros(EVENT_TS), window).start).alias("window_start")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sortWithinPartitions(EVENT_TS).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        kept = spark.read.schema(batch.schema).parquet(path)
        closed = kept.where(F.col(_CLOSED).isNotNull() & (F.col("batch_id") == batch_id)).select(
            F.col(EVENT_TS).alias("window_start"), F.col(_CLOSED).alias("window_end"))
        low, high = closed.agg(F.min("window_start"), F.max("window_end")).first()
        within = F.lit(False) if high is None else (F.col(EVENT_TS) >= low) & (F.col(EVENT_TS) < high)
        counts = (kept.where(F.col(_CLOSED).isNull() & within).select(start, "product_id", "quantity")
                  .groupBy("window_start", "product_id").agg(_sold(measure)))
        top = rank_counts(counts, None, k).join(closed, "window_start").select(
            *[as_wall_clock(F.timestamp_micros(c)).alias(c) for c in ("window_start", "window_end")],
            "product_id", "sold_quantity", "rank")
        if products is not None:        # k rows a window, read twice for their names
            top.write.mode("overwrite").parquet(f"{checkpoint}/{TOP_ROWS}")
            top = with_names(spark.read.schema(top.schema).parquet(f"{checkpoint}/{TOP_ROWS}"), products)
        top.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        if high is not None:
            _expire(kept, path, batch_id)
    return write


def _expire(kept: DataFrame, path: str, batch_id: int) -> None:
    """Delete the kept batches all of whose rows lie in windows that had
    closed before micro-batch ``batch_id`` (which takes none of them, should
    it be retried)."""
    before = kept.where(F.col("batch_id") < batch_id)
    upto = before.where(F.col(_CLOSED).isNotNull()).agg(F.max(_CLOSED)).first()[0]
    if upto is None:
        return
    waiting = before.where(F.col(_CLOSED).isNull() & (F.col(EVENT_TS) >= upto)).select("batch_id").distinct()
    needed = {r.batch_id for r in waiting.collect()}        # one a kept batch
    for n in {int(f.split("batch_id=")[-1].split("/")[0]) for f in kept.inputFiles()}:
        if n < batch_id and n not in needed:
            remove_path(kept.sparkSession, f"{path}/batch_id={n}")


def start_top_products(items: DataFrame, out_path: str, checkpoint: str, event_time: str,
                       products: DataFrame | None = None, window: str = "5 minutes",
                       k: int = 10, delay: str = "10 minutes", measure: str = "lines",
                       trigger=None, watermarked: bool = False) -> StreamingQuery:
    """ST2: top k products per closed window, appended batch by batch.

    Rows wait for their window's end as files in the checkpoint.  The stream
    is read twice a batch for that (rows, and their windows), so a
    ``watermarked`` one, which comes from a join with state of its own, keeps
    its counts in Spark's state instead."""
    if watermarked:
        feed = windowed_product_counts(items, event_time, window, delay, measure, watermarked)
        writer = _idempotent_batch_writer(out_path, lambda b: rank_windows(b, products, k))
    else:
        feed = _rows_and_closed_windows(items, event_time, window, delay)
        writer = _top_products_writer(items.sparkSession, out_path, checkpoint, products, window, k, measure)
    w = (feed.writeStream.outputMode("append").foreachBatch(writer)
         .option("checkpointLocation", checkpoint))
    if watermarked:
        return set_trigger(w, trigger).start()
    with _state_tasks(items.sparkSession, STATE_TASKS):
        return set_trigger(w, trigger).start()


def start_product_counts(items: DataFrame, out_path: str, checkpoint: str, event_time: str,
                         window: str = "5 minutes", delay: str = "10 minutes", measure: str = "lines",
                         trigger=None) -> StreamingQuery:
    """ST2 without the ranking: all counts of every closed window, which late
    rows can still be added to (``late.repair_counts``) before
    ``rank_counts``."""
    counts = windowed_product_counts(items, event_time, window, delay, measure)
    w = (counts.select(as_wall_clock(F.col("window.start")).alias("window_start"),
                       as_wall_clock(F.col("window.end")).alias("window_end"), "product_id", "sold_quantity")
         .writeStream.format("parquet").outputMode("append").option("path", out_path)
         .option("checkpointLocation", checkpoint))
    return set_trigger(w, trigger).start()


def windowed_revenue(orders: DataFrame, window: str = "3 hours",
                     delay: str = "0 seconds") -> DataFrame:
    """ST6: sales and order count per tumbling window of an order stream."""
    agg = (with_event_time(orders, "order_date", delay)
           .groupBy(F.window(EVENT_TS, window).alias("window"))
           .agg(F.sum("total_amount").alias("sales"), F.count(F.lit(1)).alias("orders")))
    return agg.select(as_wall_clock(F.col("window.start")).alias("window_start"),
                      as_wall_clock(F.col("window.end")).alias("window_end"),
                      "sales", "orders")


def start_windowed_revenue(orders: DataFrame, out_path: str, checkpoint: str,
                           window: str = "3 hours", delay: str = "0 seconds",
                           trigger=None) -> StreamingQuery:
    w = (windowed_revenue(orders, window, delay).writeStream.format("parquet")
         .outputMode("append").option("path", out_path)
         .option("checkpointLocation", checkpoint))
    return set_trigger(w, trigger).start()


def trailing_revenue(orders: DataFrame, window: str = "3 hours", slide: str = "15 minutes",
                     delay: str = "0 seconds") -> DataFrame:
    """ST6, running: sales and orders of the last ``window``, every ``slide``.

    Rows are first summed up by panes of one slide; the sliding windows are
    then built from closed panes, so a row is aggregated once and a window
    takes window / slide rows a task, however many orders it holds.  (A plain
    sliding window copies every row into each of them.)"""
    panes = (with_event_time(orders, "order_date", delay)
             .groupBy(F.window(EVENT_TS, slide).alias("pane"))
             .agg(F.sum("total_amount").alias("sales"), F.count(F.lit(1)).alias("orders")))
    agg = (panes.groupBy(F.window(F.window_time("pane"), window, slide).alias("window"))
           .agg(F.sum("sales").alias("sales"), F.sum("orders").alias("orders")))
    return agg.select(as_wall_clock(F.col("window.start")).alias("window_start"),
                      as_wall_clock(F.col("window.end")).alias("window_end"),
                      "sales", "orders")


def start_trailing_revenue(orders: DataFrame, out_path: str, checkpoint: str, window: str = "3 hours",
                           slide: str = "15 minutes", delay: str = "0 seconds", trigger=None) -> StreamingQuery:
    w = (trailing_revenue(orders, window, slide, delay).writeStream.format("parquet")
         .outputMode("append").option("path", out_path)
         .option("checkpointLocation", checkpoint))
    return set_trigger(w, trigger).start()


def window_growth(windows: DataFrame) -> DataFrame:
    """Growth of each window's sales over the window that ends where it
    starts (NULL without such a window, +Infinity/0 on a zero base); a
    regroup on the window start, not a join or an ordered window.
    Columns: window_start, window_end, sales, prev_sales, growth_pct."""
    per = windows.select("window_start", "sales",
                         (F.col("window_end") - F.col("window_start")).alias("_len"))
    # windows of one tumbling stream share one length: shift by each row's own
    step = F.col("_len")
    null = F.lit(None).cast(windows.schema["sales"].dataType)
    both = per.select(F.explode(F.array(
        F.struct(F.col("window_start").alias("k"), F.col("sales").alias("cur"),
                 null.alias("prev"), step.alias("len"), F.lit(True).alias("here")),
        F.struct((F.col("window_start") + step).alias("k"), null.alias("cur"),
                 F.col("sales").alias("prev"), step.alias("len"), F.lit(False).alias("here")),
    )).alias("e")).select("e.*")
    j = (both.groupBy("k").agg(F.max("cur").alias("sales"), F.max("prev").alias("prev_sales"),
                               F.max("len").alias("len"), F.max("here").alias("here"))
         .where("here"))
    cur, pv = F.col("sales"), F.col("prev_sales")
    return j.select(F.col("k").alias("window_start"), (F.col("k") + F.col("len")).alias("window_end"),
                    as_double(cur).alias("sales"), as_double(pv).alias("prev_sales"),
                    growth_pct(cur, pv).alias("growth_pct"))
