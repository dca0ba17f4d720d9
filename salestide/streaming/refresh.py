"""ST5: periodic KPI refresh driven by a stream (replaces the cron job).

Each trigger recomputes every KPI output from the current ingested tables
and overwrites them under one output root (the original refreshed one
folder while the dashboard read another).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from salestide.plans.job import Relations, run_batch
from salestide.streaming.common import set_trigger


def start_refresh(trigger_stream: DataFrame, load: Callable[[], Relations], out_root: str,
                  checkpoint: str, as_of=None, trigger="10 minutes", fmt: str = "csv",
                  pre_aggregates_root: str | None = None, **params) -> StreamingQuery:
    """``trigger_stream`` only paces the refresh (e.g. a file stream over the
    ingested orders, so a refresh follows new data); ``load`` returns the
    relations to recompute from.  With ``pre_aggregates_root`` (the root of
    ``incremental.start_partials``) the outputs covered by the shared
    pre-aggregates are derived from the incrementally maintained ones
    instead of the full tables."""
    def refresh(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        pre = None
        if pre_aggregates_root:
            from salestide.streaming.incremental import current_all
            pre = current_all(batch.sparkSession, pre_aggregates_root) or None
        run_batch(load(), out_root, as_of=as_of, fmt=fmt, pre_aggregates=pre, **params)

    w = (trigger_stream.writeStream.foreachBatch(refresh)
         .option("checkpointLocation", checkpoint))
    return set_trigger(w, trigger).start()
