"""Trailing look-backs from maintained panes (k02, k10, k11, t07).

A look-back ("the last three hours") has bounds that move with the clock, so
no finished window answers it.  Here every micro-batch is folded into short
panes of fixed length: per pane the sums of its orders, the customers who
signed up, the lines and units of each product.  Those partials merge exactly
(sums add, sets unite), whatever batch a row came with, so late rows need no
repair.  A look-back adds the panes that lie inside it and reads single rows
of the one or two panes that its bounds cut: no history is scanned.

Layout, for each of ``PANES``: ``<root>/<name>/panes`` and
``<root>/<name>/rows``, both partitioned by month and micro-batch and sorted
by pane, so that a look-back lists the months it touches and skips the row
groups of other panes.  A retried batch replaces its own partitions;
``expire`` drops the months that no look-back reaches any more.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salestide.functions.money import as_double, growth_pct
from salestide.functions.timefns import as_of_column, interval, interval_seconds
from salestide.operators.tables import top_named
from salestide.session import remove_path
from salestide.streaming.common import as_instant, set_trigger

LENGTH = "15 minutes"
_EPOCH = dt.datetime(1970, 1, 1)
_MICRO = dt.timedelta(microseconds=1)


SKETCH_BITS = 12                                 # HyperLogLog registers: 2**12
RELATIVE_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)    # one standard error of an estimate


@dataclass(frozen=True)
class Pane:
    """One maintained relation: its time column, the key columns of a pane's
    partials, their values (how rows are folded, how partials are merged),
    and the columns of single rows."""

    time: str
    keys: tuple[str, ...]
    values: dict
    columns: tuple[str, ...]


def _added(fold):
    return fold, F.sum


def _distinct(column: str):
    return lambda: F.hll_sketch_agg(column, SKETCH_BITS), F.hll_union_agg


PANES = {
    "sales": Pane("order_date", (), {"sales": _added(lambda: F.sum("total_amount")),
                                     "orders": _added(lambda: F.count(F.lit(1)))}, ("total_amount",)),
    # which customers signed up in a pane: sets unite, counts of them don't add
    "signups": Pane("signup_date", ("customer_id",), {}, ("customer_id",)),
    "products": Pane("order_time", ("product_id",),
                     {"lines": _added(lambda: F.count("quantity")),
                      "units": _added(lambda: F.sum("quantity").cast("bigint"))}, ("product_id", "quantity")),
    # distinct counts over any range in a few KB a pane, within RELATIVE_ERROR
    "signup_sketches": Pane("signup_date", (), {"ids": _distinct("customer_id")}, ("customer_id",)),
    "product_sketches": Pane("order_time", (), {"ids": _distinct("product_id")}, ("product_id",)),
}


def pane_number(ts: Column, length: str = LENGTH) -> Column:
    """Which pane (from 1970, on the wall clock) a time lies in."""
    return F.floor(F.unix_micros(as_instant(ts)) / F.lit(interval_seconds(length) * 1_000_000)).cast("long")


def fold(rows: DataFrame, name: str, length: str = LENGTH) -> DataFrame:
    """The partials of ``rows``: one row for each pane and key."""
    pane = PANES[name]
    timed = rows.where(F.col(pane.time).isNotNull()).withColumn("pane", pane_number(F.col(pane.time), length))
    month = F.min(F.trunc(pane.time, "month"))     # the same for all: panes fill days
    return timed.groupBy("pane", *pane.keys).agg(
        *[fn().alias(c) for c, (fn, _) in pane.values.items()], month.alias("month"))


def _publish(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id)).repartition("month").sortWithinPartitions("month", "pane")
     .write.partitionBy("month", "batch_id").option("partitionOverwriteMode", "dynamic")
     .mode("overwrite").parquet(path))


def start_panes(stream: DataFrame, name: str, root: str, checkpoint: str, length: str = LENGTH,
                trigger=None) -> StreamingQuery:
    """Keep the panes of ``name`` under ``root`` from a stream of its rows.

    ``length`` must divide a day, and be the one that the look-backs use."""
    if 86_400 % interval_seconds(length):
        raise ValueError(f"panes of {length} don't fill a day")
    pane = PANES[name]

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col(pane.time).isNotNull()).select(pane.time, *pane.columns)
        _publish(rows.withColumn("pane", pane_number(F.col(pane.time), length))
                 .withColumn("month", F.trunc(pane.time, "month")), f"{root}/{name}/rows", batch_id)
        _publish(fold(rows, name, length), f"{root}/{name}/panes", batch_id)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return set_trigger(w, trigger).start()


@dataclass(frozen=True)
class Span:
    """Times from ``low`` up to, not with, ``high`` (None: without end)."""

    low: dt.datetime
    high: dt.datetime | None = None

    def whole(self, length: str) -> tuple[int, int | None]:
        """The first pane that lies inside, and the first after it that doesn't."""
        size = interval_seconds(length) * 1_000_000
        return (-(-((self.low - _EPOCH) // _MICRO) // size),
                None if self.high is None else (self.high - _EPOCH) // _MICRO // size)


def now(spark: SparkSession, as_of=None) -> dt.datetime:
    """The as-of instant as a value, so that the months and panes a look-back
    needs are known before its files are listed."""
    return spark.range(1).select(as_of_column(as_of).cast("timestamp_ntz")).first()[0]


def back(spark: SparkSession, instant: dt.datetime, length: str) -> dt.datetime:
    return spark.range(1).select(as_of_column(instant) - interval(length)).first()[0]


def _read(spark: SparkSession, path: str, span: Span) -> DataFrame:
    """Only the months that ``span`` touches (partition pruning)."""
    df = spark.read.parquet(path).where(F.col("month") >= F.lit(span.low.date().replace(day=1)))
    return df if span.high is None else df.where(F.col("month") <= F.lit(span.high.date()))


def within(spark: SparkSession, root: str, name: str, span: Span, length: str = LENGTH) -> DataFrame:
    """The merged partials of the rows whose time lies in ``span``: its whole
    panes, and the rows of the panes its bounds cut folded on the way.
    Columns: the pane's keys and values, one row for each key."""
    pane = PANES[name]
    first, after = span.whole(length)
    time, number = F.col(pane.time), F.col("pane")
    panes = _read(spark, f"{root}/{name}/panes", span).where(number >= first)
    cut = number == first - 1
    inside = time >= F.lit(span.low).cast("timestamp_ntz")
    if after is not None:
        panes = panes.where(number < after)
        cut = cut | (number == after)
        inside = inside & (time < F.lit(span.high).cast("timestamp_ntz"))
    rows = _read(spark, f"{root}/{name}/rows", span).where(cut & inside)
    if after is None or after >= first:
        # a bound on the edge of a pane cuts none: that pane is whole
        rows = rows.where((number < first) | (F.lit(False) if after is None else number >= after))
    columns = [*pane.keys, *pane.values]
    both = panes.select(*columns).unionByName(fold(rows, name, length).select(*columns))
    if not pane.values:
        return both.distinct()
    return both.groupBy(*pane.keys).agg(*[merge(c).alias(c) for c, (_, merge) in pane.values.items()])


def new_customers(spark: SparkSession, root: str, as_of=None, lookback: str = "3 hours",
                  length: str = LENGTH) -> DataFrame:
    """k02 from panes: customers who signed up since ``as_of - lookback``."""
    low = back(spark, now(spark, as_of), lookback)
    ids = within(spark, root, "signups", Span(low), length)
    return ids.agg(F.count("customer_id").alias("customers_in_last_3hrs"))


def _sales(spark, root, span, length) -> DataFrame:
    zero = F.lit(0).cast("decimal(18,2)")
    return within(spark, root, "sales", span, length).agg(F.coalesce(F.sum("sales"), zero).alias("sales"))


def sales_window(spark: SparkSession, root: str, as_of=None, lookback: str = "3 hours",
                 length: str = LENGTH) -> DataFrame:
    """k10 from panes: sales since ``as_of - lookback``, 0 when there are none."""
    low = back(spark, now(spark, as_of), lookback)
    return _sales(spark, root, Span(low), length).select(as_double("sales").alias("sales_in_last3hrs"))


def growth_rate(spark: SparkSession, root: str, as_of=None, period: str = "3 hours",
                length: str = LENGTH) -> DataFrame:
    """k11 from panes: growth of the sales since ``as_of - period`` over
    those of the period before."""
    low = back(spark, now(spark, as_of), period)
    none = F.lit(None).cast("decimal(38,2)")
    cur = _sales(spark, root, Span(low), length).select(F.col("sales").alias("cur"), none.alias("prev"))
    prev = _sales(spark, root, Span(back(spark, low, period), low), length).select(
        none.alias("cur"), F.col("sales").alias("prev"))
    both = cur.unionByName(prev).agg(F.max("cur").alias("cur"), F.max("prev").alias("prev"))
    return both.select(growth_pct(F.col("cur"), F.col("prev")).alias("growth_rate"))


def distinct_estimate(spark: SparkSession, root: str, name: str, span: Span, length: str = LENGTH) -> DataFrame:
    """About how many ids lie in ``span``, from the sketches of its panes
    (``signup_sketches``: customers, k02; ``product_sketches``: products, k05)."""
    return within(spark, root, name, span, length).select(
        F.coalesce(F.hll_sketch_estimate("ids"), F.lit(0).cast("bigint")).alias("distinct_ids"))


def distinct_by_days(spark: SparkSession, root: str, name: str, lengths: tuple[int, ...],
                     length: str = LENGTH) -> DataFrame:
    """The estimates of all runs of so many days that begin with a day there
    is: (first_day, days, distinct_ids).  Panes are united by day once; a
    run unites its days' sketches."""
    day = F.date_from_unix_date(F.floor(F.col("pane") * interval_seconds(length) / 86_400).cast("int"))
    daily = spark.read.parquet(f"{root}/{name}/panes").groupBy(day.alias("day")).agg(
        F.hll_union_agg("ids").alias("ids"))
    runs = daily.select("ids", "day", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("days")).select(
        "ids", "days", F.explode(F.sequence(F.lit(0), F.col("days") - 1)).alias("back"), "day")
    runs = runs.select("ids", "days", F.date_sub("day", F.col("back")).alias("first_day"))
    begun = daily.select(F.col("day").alias("first_day"))
    return runs.join(begun, "first_day", "left_semi").groupBy("first_day", "days").agg(
        F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("distinct_ids"))


def top_products(spark: SparkSession, root: str, products: DataFrame, as_of=None, lookback: str = "15 minutes",
                 k: int = 10, measure: str = "lines", length: str = LENGTH) -> DataFrame:
    """t07 from panes: the products most sold since ``as_of - lookback``, by
    order lines or by units."""
    low = back(spark, now(spark, as_of), lookback)
    sold = within(spark, root, "products", Span(low), length).select(
        "product_id", F.col(measure).alias("sold_quantity"))
    return top_named(sold, products, "sold_quantity", k).select("name", "sold_quantity")


def expire(spark: SparkSession, root: str, name: str, before: dt.date) -> int:
    """Drop the months that end before ``before``; how many there were."""
    months = [r.month for r in spark.read.parquet(f"{root}/{name}/panes").select("month").distinct()
              .where(F.col("month") < F.lit(before.replace(day=1))).collect()]     # one value a month
    for month in months:
        for kind in ("panes", "rows"):
            remove_path(spark, f"{root}/{name}/{kind}/month={month}")
    return len(months)
