"""The latest version of every dimension row (customers, products).

An append-only landing keeps each version of a customer, so every join with
it fans out.  This keeps one row for each key, the newest by broker time: a
micro-batch is first reduced to its newest row a key (map-side, so a key with
many copies costs a row a task), then merged into the key's bucket, and only
the buckets that the batch touches are written again, in folders of their own.

A version table is published by a log entry that names the folder of each
touched bucket and is written last.  A reader takes every bucket's newest
folder, so it never sees half of a batch; a retried batch starts from the
buckets as they were before it and replaces its own folders.

Layout: ``<root>/data/batch_id=N/bucket=B`` and ``<root>/log/batch_id=N``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salestide.session import remove_path
from salestide.streaming.common import set_trigger
from salestide.streaming.incremental import _read

BUCKETS = 64
_LOG = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.LongType())])


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def newest(rows: DataFrame, key: str, time: str) -> DataFrame:
    """One whole row for each key: the newest by ``time`` (a null time is
    older than any), and of several at that time always the same one, the
    greatest in all its columns.  Rows without a key are left out."""
    order = F.struct(time, *[c for c in rows.columns if c not in (time, key)])
    best = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order).alias("_best"))
    return best.select(*[F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def _published(spark: SparkSession, root: str, before: int | None = None) -> list[tuple[int, int]]:
    """(bucket, batch that wrote it last), one for each bucket at most."""
    log = _read(spark, f"{root}/log", _LOG)
    if log is None:
        return []
    if before is not None:
        log = log.where(F.col("batch_id") < before)
    return [tuple(r) for r in log.groupBy("bucket").agg(F.max("batch_id").alias("batch_id")).collect()]


def _folder(root: str, batch_id: int, bucket: int) -> str:
    return f"{root}/data/batch_id={batch_id}/bucket={bucket}"


def _buckets(spark: SparkSession, root: str, places: list[tuple[int, int]], schema: T.StructType) -> DataFrame | None:
    if not places:
        return None
    return spark.read.schema(schema).parquet(*[_folder(root, n, b) for b, n in places])


def start_upsert(stream: DataFrame, root: str, checkpoint: str, key: str, time: str,
                 buckets: int = BUCKETS, trigger=None) -> StreamingQuery:
    """Keep the newest row by ``time`` of every ``key`` of ``stream`` under
    ``root``.  ``buckets`` must stay what it is: about the table's bytes /
    64 MB, so that a changed key rewrites one small file."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # both for the buckets it touches and for the merge
        changed = newest(batch, key, time).withColumn("bucket", _bucket(key, buckets)).persist()
        try:
            touched = sorted(r.bucket for r in changed.select("bucket").distinct().collect())
            if not touched:
                return
            kept = [p for p in _published(spark, root, before=batch_id) if p[0] in touched]
            rows, old = changed.drop("bucket"), _buckets(spark, root, kept, batch.schema)
            if old is not None:
                rows = newest(old.unionByName(rows), key, time)
            (rows.withColumn("bucket", _bucket(key, buckets)).repartition("bucket")
             .write.partitionBy("bucket").mode("overwrite").parquet(f"{root}/data/batch_id={batch_id}"))
            (spark.range(1).select(F.explode(F.lit(touched).cast("array<int>")).alias("bucket"),
                                   F.lit(batch_id).cast("long").alias("batch_id"))
             .coalesce(1).write.mode("overwrite").parquet(f"{root}/log/entry={batch_id}"))
        finally:
            changed.unpersist()

    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return set_trigger(w, trigger).start()


def latest(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The table as published last: one row for each key (none before the
    first batch)."""
    df = _buckets(spark, root, _published(spark, root), schema)
    return spark.createDataFrame([], schema) if df is None else df


def vacuum(spark: SparkSession, root: str, keep_batches: int = 2) -> int:
    """Delete the bucket folders that are in none of the last ``keep_batches``
    versions of the table (readers may still hold those); how many.  A log
    entry goes with the last of its folders."""
    log = _read(spark, f"{root}/log", _LOG)
    if log is None:
        return 0
    recent = [r.batch_id for r in log.select("batch_id").distinct().orderBy(F.desc("batch_id"))
              .limit(keep_batches).collect()]
    if not recent:
        return 0
    oldest = log.where(F.col("batch_id") <= min(recent)).groupBy("bucket").agg(F.max("batch_id").alias("in_use"))
    marked = log.join(oldest, "bucket").withColumn("gone", F.col("batch_id") < F.col("in_use"))
    gone = marked.where("gone").select("batch_id", "bucket").collect()      # one for each folder
    whole = [r.batch_id for r in marked.groupBy("batch_id").agg(F.min("gone").alias("gone")).where("gone").collect()]
    removed = sum(remove_path(spark, _folder(root, r.batch_id, r.bucket)) for r in gone)
    for n in whole:
        remove_path(spark, f"{root}/data/batch_id={n}")
        remove_path(spark, f"{root}/log/entry={n}")
    return removed
