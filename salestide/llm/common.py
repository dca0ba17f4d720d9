"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salestide.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table, read only through Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions: set by the user in proportion to the
    data, so the number of chunks and buckets derived from it grows with the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, lineage cut: later
    stages reread files that every executor sees, whoever is lost meanwhile."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def numbered(df: DataFrame, number: str, *order: Column) -> DataFrame:
    """``df`` with a column ``number``: 1, 2, 3... in the order given.

    Rows are dealt by ranges of the order and written, so that the ranges stay
    what they are; each range is numbered by itself and shifted by the rows of
    the ranges before it (a table of one row a range).  The order should tell
    rows apart: rows that tie in it share a range."""
    dealt = materialised(df.repartitionByRange(partitions(df.sparkSession), *order).withColumn(
        "__range", F.spark_partition_id()))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy("__range").count().select(
        "__range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return dealt.join(F.broadcast(shift), "__range").withColumn(
        number, F.col("__before") + inside).drop("__range", "__before")
