"""The batch KPI job: four relations in, ten result folders out.

Replaces the original script's 24 separate actions and driver-side
arithmetic with one lazy DataFrame per output; each output is one write
(one action).  The summary row is one job of merged scalar subqueries.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide.operators import kpis, tables
from salestide.session import remove_path, scratch_path
from salestide.sources.files import read_relation, rejected_rows
from salestide.sources.sinks import write_result


@dataclasses.dataclass
class Relations:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame


def load_relations(spark: SparkSession, paths: dict[str, str], fmt: str = "csv",
                   keep_repeated_headers: bool = False, **options) -> Relations:
    """``paths`` maps each relation name to a file, folder or glob."""
    return Relations(**{
        name: read_relation(spark, paths[name], name, fmt=fmt,
                            keep_repeated_headers=keep_repeated_headers, **options)
        for name in ("customers", "products", "orders", "order_items")})


# Output folder names (ours) -> builder.  Column names inside each output
# are the fixed ones of the original results.
def kpi_outputs(rel: Relations, as_of=None, lookback: str = "3 hours",
                top_lookback: str = "15 minutes", ltv_window: str = "10 days",
                churn_days: int = 7, per_customer: DataFrame | None = None,
                parts: DataFrame | None = None,
                per_product: DataFrame | None = None,
                per_window: DataFrame | None = None) -> dict[str, DataFrame]:
    """The ten outputs.  ``per_customer`` (``tables.customer_revenue``),
    ``parts`` (``tables.time_parts``) and ``per_product``
    (``tables.product_sales``) are optional shared pre-aggregates;
    ``per_window`` (``tables.window_revenue`` with ``ltv_window``) feeds t01."""
    c, p, o, i = rel.customers, rel.products, rel.orders, rel.order_items
    return {
        "summary_kpis": kpis.kpi_summary(c, p, o, i, as_of=as_of, lookback=lookback,
                                         period=lookback, per_customer=per_customer,
                                         per_product=per_product),
        "customer_ltv": tables.customer_ltv(o, c, window=ltv_window, per_window=per_window),
        "regional_revenue": tables.regional_revenue(o, c, per_customer=per_customer),
        "membership_revenue": tables.membership_revenue(o, c, per_customer=per_customer),
        "monthly_sales": tables.sales_by(o, "month", parts=parts),
        "weekday_sales": tables.sales_by(o, "weekday", parts=parts),
        "hourly_sales": tables.sales_by(o, "hour", parts=parts),
        "top_products": tables.top_products(o, i, p, as_of=as_of, lookback=top_lookback),
        "category_revenue": tables.category_revenue(i, p, per_product=per_product),
        "churn_risk": tables.churn_risk(o, as_of=as_of, min_days=churn_days,
                                        per_customer=per_customer),
    }


# Outputs whose size grows with the data: never squeezed into one file.
_UNBOUNDED = {"churn_risk"}


def new_run_id() -> str:
    """A run folder name that sorts in time order (UTC, microseconds) and
    stays unique across concurrent runs."""
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    return f"{now}-{uuid.uuid4().hex[:8]}"


def run_batch(rel: Relations, out_root: str, as_of=None, fmt: str = "csv",
              single_file: bool = True, parallel: int = 4, versioned: bool = False,
              folder_names: dict[str, str] | None = None, share: bool = True,
              pre_aggregates: dict[str, DataFrame] | None = None,
              timestamp_format: str | None = None, **params) -> dict[str, str]:
    """Write every KPI output under ``out_root``; returns name -> path.
    ``timestamp_format`` sets the text form of timestamps in CSV and JSON.

    ``single_file`` applies to the small, bounded outputs only.  The ten
    writes are independent jobs; up to ``parallel`` are submitted at once
    from driver threads so their stages share the executors (no data passes
    through the driver).  A failed write raises after the others finish.

    By default outputs are overwritten in place, so a reader during a
    refresh may see a folder being replaced.  ``versioned=True`` writes each
    refresh to ``<name>/run=<id>/`` instead and, once all ten are committed,
    appends the run id to ``<out_root>/published``; readers take the newest
    published run (``read_result(..., latest=True)``), so they never see a
    partial run and always see one consistent set of outputs.

    ``folder_names`` renames output folders (output key -> folder), so an
    existing reader can keep its paths.

    ``pre_aggregates`` (``incremental.current_all``) replaces the scans of
    the history by maintained aggregates: per_customer, parts, per_product
    and per_window, each used where given.  Then only the recent-window
    outputs read orders and items, through pushed-down time filters.

    ``share`` writes the pre-aggregates that several outputs need (those
    given, and revenue per customer, sales per month/weekday/hour, units and
    revenue per product) to Parquet in the shared scratch folder first, all
    submitted together, and derives the outputs from there: orders are
    scanned once for each of them, items once, and a lost executor costs no
    recomputation.  The folder is deleted when all outputs are written.
    """
    spark = rel.orders.sparkSession
    shared = dict(pre_aggregates or {})
    unknown = set(shared) - {"per_customer", "parts", "per_product", "per_window"}
    if unknown:
        raise ValueError(f"unknown pre-aggregates: {sorted(unknown)}")
    scratch = None
    if share:
        shared = {"per_customer": tables.customer_revenue(rel.orders),
                  "parts": tables.time_parts(rel.orders),
                  "per_product": tables.product_sales(rel.order_items), **shared}
        scratch = scratch_path(spark, "pre-aggregates")

        def keep(name: str) -> DataFrame:
            shared[name].write.parquet(f"{scratch}/{name}")
            return spark.read.parquet(f"{scratch}/{name}")

        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            shared = dict(zip(shared, pool.map(keep, list(shared))))
    outputs = kpi_outputs(rel, as_of=as_of, **params, **shared)
    root = out_root.rstrip("/")
    run_id = new_run_id() if versioned else None
    run = f"/run={run_id}" if versioned else ""
    folders = {name: (folder_names or {}).get(name, name) for name in outputs}
    paths = {name: f"{root}/{folders[name]}{run}" for name in outputs}

    def write(name: str) -> None:
        write_result(outputs[name], paths[name], fmt=fmt, timestamp_format=timestamp_format,
                     single_file=single_file and name not in _UNBOUNDED)

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            for f in [pool.submit(write, name) for name in outputs]:
                f.result()
    finally:
        if scratch:
            remove_path(spark, scratch)
    if versioned:
        publish_run(spark, root, run_id)
    return paths


def publish_run(spark, out_root: str, run_id: str) -> None:
    """Append one row (run, published_at) to the run log.  Append-only, so
    a reader never meets a log being rewritten."""
    spark.createDataFrame([(run_id,)], "run string") \
        .withColumn("published_at", F.current_timestamp()) \
        .coalesce(1).write.mode("append").json(f"{out_root}/published")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="Compute the sales KPI outputs.")
    ap.add_argument("--customers", required=True)
    ap.add_argument("--products", required=True)
    ap.add_argument("--orders", required=True)
    ap.add_argument("--order-items", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="csv")
    ap.add_argument("--as-of", default=None, help="wall-clock instant; default now")
    ap.add_argument("--keep-repeated-headers", action="store_true")
    ap.add_argument("--timestamp-format", default=None, help="text form of timestamps in the outputs")
    ap.add_argument("--rejects", default=None, help="folder for input rows that do not parse (CSV)")
    args = ap.parse_args(argv)
    from salestide.session import build_session
    spark = build_session()
    paths = {"customers": args.customers, "products": args.products,
             "orders": args.orders, "order_items": args.order_items}
    rel = load_relations(spark, paths, fmt=args.format,
                         keep_repeated_headers=args.keep_repeated_headers)
    run_batch(rel, args.out, as_of=args.as_of, timestamp_format=args.timestamp_format)
    if args.rejects and args.format == "csv":
        for name, path in paths.items():
            rejected_rows(spark, path, name).write.mode("overwrite").json(f"{args.rejects}/{name}")


if __name__ == "__main__":
    main()
