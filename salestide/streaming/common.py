"""Shared streaming helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

EVENT_TS = "_event_ts"


def as_instant(c):
    """A wall-clock ``TIMESTAMP_NTZ`` as the instant of that wall-clock time
    in UTC, whatever the session time zone, so event-time windows align to
    the wall clock exactly as batch ``window()`` on NTZ does.  Zone-based
    timestamps pass through unchanged."""
    # both parts are read off the wall clock itself, so no zone rule applies
    # (a cast through the session zone would lose times in a daylight-saving gap)
    fraction = (F.date_part(F.lit("SECOND"), c) * 1_000_000 % 1_000_000).cast("long")
    # unix_timestamp rounds towards 1970
    before = (c < F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")) & (fraction > 0)
    seconds = F.unix_timestamp(c) - F.when(before, 1).otherwise(0)
    return F.timestamp_micros(seconds * 1_000_000 + fraction)


def as_wall_clock(c):
    """Inverse of ``as_instant`` for window bounds: back to ``TIMESTAMP_NTZ``."""
    micros = F.unix_micros(c)
    seconds = (micros / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Add a zone-based copy of ``column`` and declare the watermark on it.
    NTZ columns are read as UTC wall clock (``as_instant``); zone-based ones
    (e.g. a broker timestamp) are used as they are."""
    src = df.schema[column].dataType
    ts = as_instant(F.col(column)) if isinstance(src, T.TimestampNTZType) \
        else F.col(column).cast("timestamp")
    return df.withColumn(EVENT_TS, ts).withWatermark(EVENT_TS, delay)


def set_trigger(writer: DataStreamWriter, trigger) -> DataStreamWriter:
    """``None`` (as fast as data comes), ``"availableNow"`` (drain what is
    there, then stop), ``"once"``, or a processing-time interval text."""
    if trigger is None:
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def late_rows(query) -> int:
    """Rows that ``query`` dropped as later than its watermark delay, over the
    batches its progress still lists.  Event-time results are those of any
    cutting into micro-batches as long as this is 0: the delay must cover
    the disorder of the stream."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p["stateOperators"])


def fill_batch(spark: SparkSession, path: str, schema: T.StructType, files: int) -> None:
    """Empty Parquet files in ``path``, up to the next multiple of ``files``.

    A file stream is cut by number of files (``maxFilesPerTrigger``): if every
    batch has ``files`` of them, each trigger takes whole batches."""
    there = len(spark.read.schema(schema).parquet(path).inputFiles())
    for _ in range(-there % files):
        spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
