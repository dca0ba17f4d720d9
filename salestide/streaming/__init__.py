"""Structured Streaming versions of the real-time KPIs.

Streams carry TIMESTAMP_NTZ event times like the batch relations.
Watermarks need zone-based timestamps, so each operator derives
``_event_ts`` by reading the wall clock as UTC (``common.as_instant``) and
converts window bounds back.  Windows therefore align to the wall clock
exactly as batch ``window()`` does, whatever the session time zone.
"""

from salestide.streaming.common import late_rows
from salestide.streaming.churn import churn_alerts, start_churn_alerts
from salestide.streaming.ingest import dedupe, start_ingest
from salestide.streaming.refresh import start_refresh
from salestide.streaming.windows import (
    items_with_order_time, rank_counts, rank_windows, start_product_counts, start_top_products,
    start_trailing_revenue, start_windowed_revenue, trailing_revenue, window_growth, windowed_product_counts,
    windowed_revenue,
)

__all__ = ["start_ingest", "dedupe", "churn_alerts", "start_churn_alerts", "start_refresh",
           "items_with_order_time", "windowed_product_counts", "rank_counts", "rank_windows",
           "start_product_counts", "start_top_products", "windowed_revenue", "start_windowed_revenue",
           "trailing_revenue", "start_trailing_revenue", "window_growth", "late_rows"]
