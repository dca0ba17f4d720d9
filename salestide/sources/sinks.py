"""S10: result sink."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_result(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False,
                 mode: str = "overwrite", partition_by: list[str] | None = None,
                 timestamp_format: str | None = None) -> None:
    """Write a result.  ``single_file`` (one part file, as the dashboard
    expects) is only for results already reduced to a few rows: it pulls
    the last stage into one task.  Sorted input keeps its order.
    ``timestamp_format`` formats timestamps in text outputs only (e.g.
    ``"yyyy-MM-dd HH:mm:ss"``, the original's text form); the data keep
    their types everywhere else."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    if timestamp_format and fmt in ("csv", "json"):
        w = (w.option("timestampFormat", timestamp_format)
             .option("timestampNTZFormat", timestamp_format))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)
