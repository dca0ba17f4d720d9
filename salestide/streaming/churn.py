"""ST3: stateful churn detection on an order stream.

A customer "goes idle" when ``min_days`` pass after an order without a new
one.  That is a session window per customer with gap ``min_days``: each
order extends the customer's open session, and the session closes when the
watermark passes ``last order + min_days``.  In append mode every closed
session is emitted once, so each emitted row is one churn alert
(customer, first and last order of the active spell).  The state is the
built-in, checkpointed session state (no Python in the hot path).  A
customer who goes idle twice is reported twice.  The result does not depend
on how the stream is cut into micro-batches as long as ``delay`` covers the
disorder of the orders; later rows are dropped by the watermark and counted
by ``late_rows``.

With ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition``
on (see ``salestide.session.DEFAULTS``) sessions are merged map-side before
the shuffle, so a customer with a third of all orders costs a few rows per
task, not a third of the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salestide.streaming.common import EVENT_TS, set_trigger, with_event_time


def churn_alerts(orders: DataFrame, min_days: int = 7, delay: str = "0 seconds") -> DataFrame:
    """Streaming DataFrame of (customer_id, session_start, last_ordered_date):
    one row each time a customer goes ``min_days`` without ordering."""
    # a fixed length (hours): calendar days would be added in the session
    # time zone and stretch or shrink across daylight-saving changes
    gap = f"{int(min_days) * 24} hours"
    return (with_event_time(orders.select("customer_id", "order_date"), "order_date", delay)
            .groupBy("customer_id", F.session_window(EVENT_TS, gap).alias("s"))
            .agg(F.min("order_date").alias("session_start"),
                 F.max("order_date").alias("last_ordered_date"))
            .select("customer_id", "session_start", "last_ordered_date"))


def start_churn_alerts(orders: DataFrame, out_path: str, checkpoint: str, min_days: int = 7,
                       delay: str = "0 seconds", trigger=None) -> StreamingQuery:
    w = (churn_alerts(orders, min_days, delay).writeStream.format("parquet")
         .outputMode("append").option("path", out_path)
         .option("checkpointLocation", checkpoint))
    return set_trigger(w, trigger).start()
