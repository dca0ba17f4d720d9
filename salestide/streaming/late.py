"""Rows that come after the watermark: kept aside, and added to what closed.

Spark drops a row that a stateful operator sees later than its watermark.
``start_landing`` marks such rows before any operator sees them: it keeps the
greatest event time of all earlier batches, as Spark does, and writes every
row of a batch either as on time or as late.  The stateful queries read the
on-time part, of which they refuse nothing; the late part is a table.

Each ``repair_*`` takes what a closed query wrote and the late rows, and
returns what the query would have written with a watermark that covers all
disorder.  Sums and counts are merged, sessions are joined where a late order
bridges or extends them, copies are dropped again.

``on_time`` must be drained with the landing's ``delay`` or a longer one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salestide.functions.timefns import interval
from salestide.streaming.common import fill_batch, set_trigger
from salestide.streaming.incremental import _read

_SEEN = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("seen", T.TimestampNTZType())])


def _seen_before(spark: SparkSession, out: str, batch_id: int) -> dt.datetime | None:
    """The greatest event time of the batches before ``batch_id``."""
    log = _read(spark, f"{out}/seen", _SEEN)
    return None if log is None else log.where(F.col("batch_id") < batch_id).agg(F.max("seen")).first()[0]


def start_landing(stream: DataFrame, out: str, checkpoint: str, event_time: str, delay: str = "1 hour",
                  trigger=None, files: int | None = None) -> StreamingQuery:
    """Write every row of ``stream`` to ``<out>/on_time`` or ``<out>/late``,
    by micro-batch (a retried batch replaces its own).  Late is what is
    ``delay`` or more older than the newest row of the batches before (Spark
    drops a row that is as old as the watermark, too); rows without an event
    time are on time (no operator closes on them).
    ``files``: each batch's on-time rows make exactly so many files (empty
    ones included), so that ``on_time`` can take whole batches; by default as
    many as the batch has tasks."""
    ts = F.col(event_time)

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _seen_before(spark, out, batch_id)
        late = F.lit(False) if seen is None else F.coalesce(
            ts <= F.lit(seen).cast("timestamp_ntz") - interval(delay), F.lit(False))
        # the batch's rows are written twice and summed up once
        batch.persist()
        try:
            for name, rows in (("on_time", batch.where(~late)), ("late", batch.where(late))):
                if files:
                    rows = rows.coalesce(files)
                rows.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")
            if files:
                fill_batch(spark, f"{out}/on_time/batch_id={batch_id}", batch.schema, files)
            (batch.agg(F.max(ts).cast("timestamp_ntz").alias("seen"))
             .select(F.lit(batch_id).cast("long").alias("batch_id"), "seen")
             .write.mode("overwrite").parquet(f"{out}/seen/entry={batch_id}"))
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return set_trigger(w, trigger).start()


def on_time(spark: SparkSession, out: str, schema: T.StructType, batches_per_trigger: int | None = None,
            files: int = 1) -> DataFrame:
    """The on-time rows as a stream, in the order they were landed.  To take
    ``batches_per_trigger`` landed batches at a time, ``files`` must be the
    landing's: a part of a batch moves the watermark past the rest of it."""
    reader = spark.readStream.schema(schema)
    if batches_per_trigger:
        reader = reader.option("maxFilesPerTrigger", batches_per_trigger * files)
    return reader.parquet(f"{out}/on_time").select(*schema.fieldNames())


def late(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The late rows landed so far."""
    df = _read(spark, f"{out}/late", schema)
    return spark.createDataFrame([], schema) if df is None else df.select(*schema.fieldNames())


def repair_counts(counts: DataFrame, late_items: DataFrame, event_time: str, window: str,
                  measure: str = "lines", until=None) -> DataFrame:
    """ST2: lines (or units) a window and product with the late items added.
    ``counts`` has window_start, window_end, product_id, sold_quantity;
    ``until`` leaves out windows that have not closed yet."""
    sold = F.count("quantity") if measure == "lines" else F.sum("quantity").cast("bigint")
    more = (late_items.groupBy(F.window(event_time, window).alias("w"), "product_id").agg(sold.alias("sold_quantity"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "product_id",
                    "sold_quantity"))
    both = counts.select(*more.columns).unionByName(_closed(more, "window_end", until))
    return both.groupBy("window_start", "window_end", "product_id").agg(
        F.sum("sold_quantity").alias("sold_quantity"))


def repair_revenue(windows: DataFrame, late_orders: DataFrame, window: str, until=None) -> DataFrame:
    """ST6: sales and orders a window with the late orders added."""
    more = (late_orders.groupBy(F.window("order_date", window).alias("w"))
            .agg(F.sum("total_amount").alias("sales"), F.count(F.lit(1)).alias("orders"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "sales", "orders"))
    both = windows.select(*more.columns).unionByName(_closed(more, "window_end", until))
    return both.groupBy("window_start", "window_end").agg(
        F.sum("sales").alias("sales"), F.sum("orders").alias("orders"))


def _spells(orders: DataFrame, min_days: int) -> DataFrame:
    """Each customer's runs of orders without a gap (merged map-side, so many
    orders of one customer cost a row a spell and task)."""
    return (orders.where("customer_id is not null")
            .groupBy("customer_id", F.session_window(F.col("order_date"), f"{int(min_days) * 24} hours"))
            .agg(F.min("order_date").alias("session_start"), F.max("order_date").alias("last_ordered_date"))
            .select("customer_id", "session_start", "last_ordered_date"))


def repair_churn(alerts: DataFrame, late_orders: DataFrame, on_time_orders: DataFrame, min_days: int = 7,
                 until=None) -> DataFrame:
    """ST3: the spells without a gap of ``min_days`` that the alerts' spells
    and the late orders make up together; alerts of customers without late
    orders stay as they are.

    A late order may also belong to a spell that is still open in the stream:
    those are taken from the on-time orders after a customer's last alert (of
    customers with late orders only).  ``until``: the time up to which the
    stream has closed; a spell that a late order keeps open longer is no
    alert yet."""
    gap = interval(f"{int(min_days) * 24} hours")
    alerts = alerts.select("customer_id", "session_start", "last_ordered_date")
    spells = _spells(late_orders, min_days)
    touched = spells.select("customer_id").distinct()
    closed = alerts.join(touched, "customer_id", "left_semi")
    last = closed.groupBy("customer_id").agg(F.max("last_ordered_date").alias("_last"))
    still_open = (on_time_orders.select("customer_id", "order_date").join(touched, "customer_id", "left_semi")
                  .join(last, "customer_id", "left")
                  .where(F.col("_last").isNull() | (F.col("order_date") > F.col("_last"))))
    parts = closed.unionByName(spells).unionByName(_spells(still_open, min_days))
    by = Window.partitionBy("customer_id").orderBy("session_start", "last_ordered_date")
    before = F.max("last_ordered_date").over(by.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("session_start") > before + gap), 1).otherwise(0)
    joined = (parts.withColumn("_new", new)
              .withColumn("_spell", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("customer_id", "_spell").agg(F.min("session_start").alias("session_start"),
                                                    F.max("last_ordered_date").alias("last_ordered_date"))
              .drop("_spell"))
    if until is not None:
        joined = joined.where(F.col("last_ordered_date") + gap <= until)
    return alerts.join(touched, "customer_id", "left_anti").unionByName(joined)


def repair_copies(rows: DataFrame, late_rows: DataFrame, key: str, event_time: str) -> DataFrame:
    """ST4: ``rows`` and the late rows whose key is not among them, one for
    each key (the oldest; of several the least in all columns)."""
    order = F.struct(event_time, *[c for c in late_rows.columns if c not in (key, event_time)])
    once = late_rows.groupBy(key).agg(F.min(order).alias("_first")).select(
        *[F.col(key) if c == key else F.col(f"_first.{c}").alias(c) for c in late_rows.columns])
    return rows.unionByName(once.join(rows.select(key), key, "left_anti").select(*rows.columns))


def _closed(windows: DataFrame, end: str, until) -> DataFrame:
    return windows if until is None else windows.where(F.col(end) <= until)
