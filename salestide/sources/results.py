"""S11-S12: read written results back (what the dashboard did with pandas)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salestide.schemas import SUMMARY


def _load(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame | None:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        df = reader.format(fmt).load(path)
        df.columns  # resolves the relation (lazily analysed sessions too)
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def latest_run(spark: SparkSession, out_root: str) -> str | None:
    """The newest run id in ``<out_root>/published`` (the log the batch job
    appends to after committing all outputs of a run), or None."""
    log = _load(spark, f"{out_root.rstrip('/')}/published",
                T.StructType([T.StructField("run", T.StringType()),
                              T.StructField("published_at", T.TimestampType())]), "json")
    if log is None:
        return None
    row = log.select(F.max("run")).first()
    return row[0] if row else None


def _latest_path(spark: SparkSession, path: str) -> str:
    root, _, name = path.rstrip("/").rpartition("/")
    run = latest_run(spark, root)
    return f"{root}/{name}/run={run}" if run else f"{root}/{name}/run=none"


def read_result(spark: SparkSession, path: str, schema: T.StructType,
                fmt: str = "csv", latest: bool = False) -> DataFrame:
    """All part files of a result directory with an explicit schema; an
    empty relation of that schema when the directory does not exist yet.
    ``latest`` reads the newest published run of a versioned output."""
    if latest:
        path = _latest_path(spark, path)
    df = _load(spark, path, schema, fmt)
    return df if df is not None else spark.createDataFrame([], schema)


def read_summary(spark: SparkSession, path: str, fmt: str = "csv",
                 latest: bool = False) -> DataFrame:
    """The one-row KPI summary, every missing KPI as 0 (no truncation of
    fractional KPIs)."""
    zero = {f.name: F.lit(0).cast(f.dataType) for f in SUMMARY.fields}
    if latest:
        path = _latest_path(spark, path)
    df = _load(spark, path, SUMMARY, fmt)
    if df is None:
        # a row of zeros, as a summary that has not been written yet
        return spark.range(1).select(*[zero[f.name].alias(f.name) for f in SUMMARY.fields])
    return df.select(*[F.coalesce(F.col(f.name), zero[f.name]).alias(f.name)
                       for f in SUMMARY.fields])
