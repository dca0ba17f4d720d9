"""Co-partitioned storage: tables whose rows are dealt into buckets by a key
when they are written, so that joins and aggregates on that key read their
side of a bucket and exchange nothing (J6, J8).

Orders and items are bucketed by ``order_id``; items are kept a second time,
in the columns that product queries need, by ``product_id``, like products.
Both sides of a join need the same number of buckets: about the larger
table's bytes / 128 MB / batches between compactions.

A table is a folder; ``open_table`` names it in the session's catalog.  The
stream writes each micro-batch into a partition of its own (a retried batch
replaces it); ``compact`` writes all batches as one, so that a bucket is one
sorted file again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salestide.streaming.common import set_trigger

BATCH = "batch_id"


@dataclass(frozen=True)
class Layout:
    """Where a relation is kept, by which key, in how many buckets."""

    name: str
    path: str
    key: str
    buckets: int
    schema: T.StructType

    def ddl(self) -> str:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        return (f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {BATCH} BIGINT) USING parquet "
                f"PARTITIONED BY ({BATCH}) CLUSTERED BY ({self.key}) SORTED BY ({self.key}) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'")


def open_table(spark: SparkSession, layout: Layout) -> DataFrame:
    """The table as it is on storage, without the batch column."""
    spark.sql(layout.ddl())
    spark.sql(f"MSCK REPAIR TABLE {layout.name}")
    return spark.table(layout.name).drop(BATCH)


def write_batch(rows: DataFrame, layout: Layout, batch_id: int) -> None:
    """``rows`` as partition ``batch_id`` of the table, replacing it.  Rows
    are first dealt as the buckets are, so a task writes whole buckets and a
    batch makes one file a bucket."""
    spark = rows.sparkSession
    spark.sql(layout.ddl())
    dealt = rows.select(*layout.schema.fieldNames()).repartition(layout.buckets, layout.key)
    spark.sql(f"INSERT OVERWRITE TABLE {layout.name} PARTITION ({BATCH} = {int(batch_id)}) SELECT * FROM {{dealt}}",
              dealt=dealt)


def start_bucketed(stream: DataFrame, layouts: list[Layout], checkpoint: str, trigger=None) -> StreamingQuery:
    """Write every micro-batch of ``stream`` into each of ``layouts``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for layout in layouts:
            write_batch(batch, layout, batch_id)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return set_trigger(w, trigger).start()


def compact(spark: SparkSession, layout: Layout, into: Layout) -> DataFrame:
    """All batches of ``layout`` as the one batch of ``into`` (another name
    and folder, same key and buckets): a bucket is one sorted file again."""
    if (layout.key, layout.buckets) != (into.key, into.buckets) or layout.path == into.path:
        raise ValueError("compact keeps key and buckets and writes a folder of its own")
    # read as plain files: over the table's own buckets no exchange would be planned
    rows = spark.read.parquet(layout.path).select(*layout.schema.fieldNames())
    write_batch(rows, into, 0)
    return open_table(spark, into)
