"""ST3 on a quiet stream: an alarm that needs no later event.

A session window closes only when another order moves the watermark, so a
stream that stops never reports anyone.  Here each customer's last order is
keyed state with a timer on the clock: the alarm is due ``min_days`` after
the last order, and Spark runs batches for timers whether rows arrive or not.
A later order moves the timer.  After the alarm the customer's state is gone;
a time to live drops what a lost timer would leave behind.

The state holds one time for each active customer and lives in RocksDB
(``session.LARGE_STATE``), which this operator requires.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from salestide.streaming.common import as_instant, as_wall_clock, set_trigger

_DAY_MS = 86_400_000


class _Alarm(StatefulProcessor):
    """State: the last order in microseconds since 1970, on the wall clock."""

    def __init__(self, days: float):
        self.wait_ms = int(days * _DAY_MS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "micros long", ttlDurationMs=4 * self.wait_ms + _DAY_MS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(part["micros"].max()) for part in rows)
        if self.last.exists():
            newest = max(newest, self.last.get()[0])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.last.update((newest,))
        # a due time in the past rings with the next batch
        self.handle.registerTimer(max(newest // 1000 + self.wait_ms, timerValues.getCurrentProcessingTimeInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            micros = self.last.get()[0]
            self.last.clear()
            yield pd.DataFrame({"customer_id": [key[0]], "micros": [micros]})

    def close(self) -> None:
        pass


def idle_alarms(orders: DataFrame, min_days: float = 7) -> DataFrame:
    """Streaming (customer_id, last_ordered_date), one row each time a
    customer's last order is ``min_days`` ago by the clock (read in UTC, like
    event times).  Orders without a customer or a time raise no alarm."""
    kind = orders.schema["customer_id"].dataType.simpleString()
    timed = orders.where("customer_id is not null and order_date is not null").select(
        "customer_id", F.unix_micros(as_instant(F.col("order_date"))).alias("micros"))
    due = timed.groupBy("customer_id").transformWithStateInPandas(
        statefulProcessor=_Alarm(min_days), outputStructType=f"customer_id {kind}, micros long",
        outputMode="append", timeMode="processingTime")
    return due.select("customer_id", as_wall_clock(F.timestamp_micros("micros")).alias("last_ordered_date"))


def start_idle_alarms(orders: DataFrame, out_path: str, checkpoint: str, min_days: float = 7,
                      trigger="1 minute") -> StreamingQuery:
    """``trigger`` is how often timers are looked at."""
    w = (idle_alarms(orders, min_days).writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    return set_trigger(w, trigger).start()
