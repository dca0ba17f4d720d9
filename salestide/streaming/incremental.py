"""Incrementally maintained pre-aggregates for the periodic refresh.

The batch job's shared pre-aggregates (revenue, orders, first and last
order per customer; sales per month/weekday/hour; units and revenue per
product; revenue per 10-day window and customer) are sums, counts, minima
and maxima, so they decompose: the aggregate of all orders is the sum of the
aggregates of any split of them.  A streaming query over the ingested
orders and items therefore only aggregates each micro-batch's new rows and
appends that partial to ``<root>/<name>/partials/batch_id=N`` (overwrite of
its own folder, so a retried batch is idempotent).  Readers re-sum the
latest compacted base and the partials written after it; ``compact`` folds
them into a new base, published through an append-only log so a reader
never sees a half-written one.  Nothing is updated in place and no state
store is needed.  The refresh then derives the KPIs from aggregates whose
size follows the number of keys, not the history.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salestide.operators.tables import (
    customer_revenue, product_sales, time_parts, window_revenue,
)
from salestide.session import remove_path
from salestide.streaming.common import set_trigger

# name -> (source relation, partial builder, key columns, {column: merge}).
# Every merge (sum, min, max) is exact over any split of the rows.  The
# windowed revenue's length is a parameter of ``start_partials``.
AGGREGATES = {
    "per_customer": ("orders", customer_revenue, ["customer_id"],
                     {"revenue": "sum", "orders": "sum", "rows": "sum", "first_order": "min",
                      "last_order": "max"}),
    "parts": ("orders", time_parts, ["order_month", "order_weekday", "order_hour"],
              {"sales": "sum"}),
    "per_product": ("order_items", product_sales, ["product_id"],
                    {"units": "sum", "revenue": "sum"}),
    "per_window": ("orders", window_revenue, ["w", "customer_id"], {"ltv": "sum"}),
}


def _merge(df: DataFrame, keys: list[str], merges: dict[str, str]) -> DataFrame:
    fns = {"sum": F.sum, "min": F.min, "max": F.max}
    return df.groupBy(*keys).agg(*[fns[m](c).alias(c) for c, m in merges.items()])

_LOG = T.StructType([T.StructField("upto", T.LongType()), T.StructField("folder", T.StringType()),
                     T.StructField("published_at", T.TimestampType())])


def _read(spark: SparkSession, path: str, schema: T.StructType | None = None,
          fmt: str = "parquet") -> DataFrame | None:
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        df = reader.format(fmt).load(path)
        df.columns
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) \
                or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _partials_writer(root: str, names: list[str], ltv_window: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        if len(names) > 1:      # read more than once
            batch.persist()
        try:
            for name in names:
                _src, build, _keys, _sums = AGGREGATES[name]
                part = (window_revenue(batch, ltv_window) if name == "per_window"
                        else build(batch))
                (part.write.mode("overwrite")
                 .parquet(f"{root}/{name}/partials/batch_id={batch_id}"))
        finally:
            if len(names) > 1:
                batch.unpersist()
    return write


def start_partials(orders: DataFrame, items: DataFrame, root: str, checkpoint_root: str,
                   trigger=None, ltv_window: str = "10 days") -> list[StreamingQuery]:
    """Two streaming queries (orders, items) appending per-batch partials of
    the pre-aggregates under ``root``.  ``ltv_window`` is the window length
    of the maintained per-(window, customer) revenue; keep it equal to the
    job's ``ltv_window`` (windows are epoch-aligned, so partials re-add
    exactly)."""
    queries = []
    for stream, relation in ((orders, "orders"), (items, "order_items")):
        names = [n for n, spec in AGGREGATES.items() if spec[0] == relation]
        w = (stream.writeStream.foreachBatch(_partials_writer(root, names, ltv_window))
             .option("checkpointLocation", f"{checkpoint_root}/{relation}"))
        queries.append(set_trigger(w, trigger).start())
    return queries


def _latest_base(spark: SparkSession, root: str, name: str) -> tuple[int, str] | None:
    """(last batch id covered, folder) of the base published last."""
    log = _read(spark, f"{root}/{name}/base_log", _LOG, "json")
    if log is None:
        return None
    row = log.where(F.col("upto").isNotNull()).agg(F.max(F.struct("upto", "published_at", "folder")).alias("m")).first()
    return (row.m.upto, f"{root}/{name}/base/{row.m.folder}") if row.m else None


def current(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The pre-aggregate over everything ingested so far: the latest base
    plus the partials written after it, re-summed per key.  None before the
    first batch.  A published base that cannot be read is an error, never an
    empty history."""
    _src, _build, keys, merges = AGGREGATES[name]
    sums = list(merges)
    latest = _latest_base(spark, root, name)
    parts = []
    if latest is not None:
        parts.append(spark.read.parquet(latest[1]).select(*keys, *sums))
    partials = _read(spark, f"{root}/{name}/partials")
    if partials is not None:
        if latest is not None:
            partials = partials.where(F.col("batch_id") > latest[0])
        parts.append(partials.select(*keys, *sums))
    if not parts:
        return None
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return _merge(union, keys, merges)


def compact(spark: SparkSession, root: str, name: str, keep_partials: bool = False) -> int | None:
    """Fold the base and the partials after it into a new base in a folder of
    its own and publish it last; returns the last batch id it covers (None
    when there is nothing).  Without new partials nothing is written, so a
    repeated call is harmless; a call that dies before publishing leaves the
    old base in force.  Partials that the base *before* this one already
    covered are then deleted (a reader that started from that base still
    needs the later ones); ``keep_partials`` keeps all."""
    partials = _read(spark, f"{root}/{name}/partials")
    latest = _latest_base(spark, root, name)
    done = latest[0] if latest is not None else None
    if partials is None:
        return done
    # only partials up to ``upto`` (a batch may land while compacting)
    upto = partials.agg(F.max("batch_id")).first()[0]
    if upto is None or (done is not None and upto <= done):
        return done
    _src, _build, keys, merges = AGGREGATES[name]
    union = partials.where(F.col("batch_id") <= upto)
    if latest is not None:
        union = union.where(F.col("batch_id") > done)
    union = union.select(*keys, *merges)
    if latest is not None:
        union = union.unionByName(spark.read.parquet(latest[1]).select(*keys, *merges))
    folder = f"upto={upto}-{uuid.uuid4().hex[:8]}"
    _merge(union, keys, merges).write.parquet(f"{root}/{name}/base/{folder}")
    spark.createDataFrame([(int(upto), folder)], "upto long, folder string") \
        .withColumn("published_at", F.current_timestamp()) \
        .coalesce(1).write.mode("append").json(f"{root}/{name}/base_log")
    if done is not None and not keep_partials:
        old = partials.where(F.col("batch_id") <= done).select("batch_id").distinct().collect()
        for row in old:  # one folder per micro-batch since the compaction before
            remove_path(spark, f"{root}/{name}/partials/batch_id={row.batch_id}")
    return int(upto)


def current_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """``run_batch(..., pre_aggregates=current_all(spark, root))``."""
    out = {}
    for name in AGGREGATES:
        df = current(spark, root, name)
        if df is not None:
            out[name] = df
    return out
