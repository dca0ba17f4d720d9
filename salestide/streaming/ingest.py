"""ST1/ST4: multi-topic JSON ingest into one table per relation.

One streaming query per relation, each with its own checkpoint, so a table
can be replayed or re-partitioned alone; the file sink commits a batch's
files and the source offsets together, so restarts neither lose nor repeat
rows (the original consumer auto-committed offsets independently of its CSV
writes).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from salestide.schemas import RELATIONS
from salestide.sources.stream import land, rejected, route
from salestide.streaming.common import EVENT_TS, set_trigger, with_event_time

def dedupe(df: DataFrame, key: str, event_time: str, delay: str = "1 hour",
           strategy: str = "first_seen") -> DataFrame:
    """ST4: drop redelivered messages (same ``key``).

    ``first_seen`` (default) emits a key's first copy at once and drops
    copies arriving within ``delay`` of event time of it
    (``dropDuplicatesWithinWatermark``); state older than the watermark is
    evicted.  It has no map-side step, so all copies of one key meet in one
    task; ``collapse`` is the form for bursts.  Rows that come later than
    ``delay`` behind the newest one are dropped by either (Spark's watermark;
    ``late_rows(query)`` counts them): ``delay`` must cover the disorder.

    ``collapse`` groups by (key, event time) in append mode instead: the
    streaming aggregate's partial step collapses copies inside each input
    task before the shuffle, so even a burst where one message's copies are
    a third of all rows reaches the shuffle as one row per task.  A key is
    emitted once the watermark passes its event time (latency = ``delay``);
    copies must carry the same event time, as redelivered messages do.
    """
    marked = with_event_time(df, event_time, delay)
    if strategy == "first_seen":
        return marked.dropDuplicatesWithinWatermark([key]).drop(EVENT_TS)
    if strategy != "collapse":
        raise ValueError("strategy must be 'first_seen' or 'collapse'")
    rest = [c for c in df.columns if c not in (key, event_time)]
    return (marked.groupBy(key, event_time, EVENT_TS)
            .agg(*[F.first(c).alias(c) for c in rest])
            .select(*df.columns))


def start_ingest(messages: DataFrame | Callable[[str], DataFrame], out_root: str,
                 checkpoint_root: str,
                 topics: dict[str, str], fmt: str = "parquet", trigger=None,
                 schemas: dict[str, T.StructType] | None = None,
                 dedup: dict[str, tuple] | None = None,
                 partition_by: dict[str, list[str]] | None = None,
                 keep: tuple[str, ...] = (), quarantine: bool = False) -> list[StreamingQuery]:
    """Start one append query per topic writing ``out_root/<relation>``.

    ``messages`` is one stream of all topics, or a function ``topic ->
    stream`` so that each query reads only its own topic (with Kafka:
    ``lambda t: kafka_messages(spark, servers, [t])``; a shared all-topic
    subscription would make every query read every topic).

    ``topics`` maps topic -> relation; ``dedup`` maps relation ->
    (key, event-time column, delay[, strategy]); ``partition_by`` maps relation ->
    columns (e.g. an order day) for partition pruning downstream; ``keep``
    stores message columns alongside (e.g. ``("timestamp",)`` so the item
    table has an event time for the windowed top-N, and every relation one to
    be de-duplicated by: ``dedup={"order_items": ("item_id", "timestamp", "1
    hour")}``); ``quarantine`` adds one query per topic that writes the
    messages which do not decode to ``out_root/_rejected/<relation>``."""
    queries = []
    if quarantine:
        for topic, relation in topics.items():
            source = messages(topic) if callable(messages) else messages.where(F.col("topic") == topic)
            sch = (schemas or {}).get(relation)
            bad = rejected(source, relation, schema=sch,
                           id_column=RELATIONS[relation][1] if sch is not None else None)
            w = (bad.writeStream.format("json").outputMode("append")
                 .option("path", f"{out_root}/_rejected/{relation}")
                 .option("checkpointLocation", f"{checkpoint_root}/_rejected/{relation}"))
            queries.append(set_trigger(w, trigger).start())
    if callable(messages):
        frames = {}
        for topic, relation in topics.items():
            frames.update(route(messages(topic), {topic: relation}, schemas, keep))
    else:
        frames = route(messages, topics, schemas, keep)
    for relation, df in frames.items():
        if dedup and relation in dedup:
            df = dedupe(df, *dedup[relation])
        w = (df.writeStream.format(fmt).outputMode("append")
             .option("path", f"{out_root}/{relation}")
             .option("checkpointLocation", f"{checkpoint_root}/{relation}"))
        if partition_by and relation in partition_by:
            w = w.partitionBy(*partition_by[relation])
        queries.append(set_trigger(w, trigger).start())
    return queries


def start_landing(messages: DataFrame, out: str, checkpoint: str, keep: tuple[str, ...] = (),
                  trigger=None) -> StreamingQuery:
    """Append every message to one table, partitioned by topic, with its
    whole value as VARIANT: relations are extracted from it (``extract``) and
    a field that appears later is readable from the day it was sent."""
    w = (land(messages, keep).writeStream.format("parquet").outputMode("append").partitionBy("topic")
         .option("path", out).option("checkpointLocation", checkpoint))
    return set_trigger(w, trigger).start()
