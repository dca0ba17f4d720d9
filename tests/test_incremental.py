"""Incrementally maintained pre-aggregates equal a full recomputation,
before and after compaction, and feed the batch job unchanged."""

from pyspark.sql import functions as F

from salestide.operators.tables import (
    customer_revenue, product_sales, time_parts, window_revenue,
)
from salestide.plans.job import Relations, run_batch
from salestide.session import scratch_path
from salestide.streaming import incremental
from tests import fixtures as fx

SPLITS = [("2025-05-01", "2025-05-05"), ("2025-05-05", "2025-05-08 01:00"),
          ("2025-05-08 01:00", "2025-06-01")]


def _rows(df, keys):
    return sorted(tuple(r) for r in df.select(*keys, *[c for c in df.columns
                                                         if c not in keys]).collect())


def _write_in_parts(spark, o, i, root):
    timed = i.join(o.select("order_id", "order_date"), "order_id")
    for n, (lo, hi) in enumerate(SPLITS):
        cond = (F.col("order_date") >= lo) & (F.col("order_date") < hi)
        o.where(cond).coalesce(1).write.parquet(f"{root}/orders/part{n}")
        timed.where(cond).select(*i.columns).coalesce(1).write.parquet(
            f"{root}/items/part{n}")


def _run(spark, src, agg_root, ck, o, i, upto_files):
    orders = (spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{src}/orders/part[0-{upto_files - 1}]"))
    items = (spark.readStream.schema(i.schema).option("maxFilesPerTrigger", 1)
             .parquet(f"{src}/items/part[0-{upto_files - 1}]"))
    for q in incremental.start_partials(orders, items, agg_root, ck, trigger="availableNow"):
        q.awaitTermination()


def test_partials_compaction_and_job(spark):
    c, p, o, i = fx.frames(spark)
    src, root, ck = scratch_path(spark, "inc-src"), scratch_path(spark, "inc"), \
        scratch_path(spark, "inc-ck")
    _write_in_parts(spark, o, i, src)
    full = {"per_customer": customer_revenue(o), "parts": time_parts(o),
            "per_product": product_sales(i), "per_window": window_revenue(o)}

    def check():
        for name, want in full.items():
            keys = incremental.AGGREGATES[name][2]
            got = incremental.current(spark, root, name)
            assert _rows(got, keys) == _rows(want, keys), name

    # two of three files, then compaction, then the third file
    _run(spark, src, root, ck, o, i, 2)
    assert incremental.compact(spark, root, "per_customer") is not None
    _run(spark, src, root, ck, o, i, 3)
    check()
    for name in full:
        incremental.compact(spark, root, name)
    check()

    for aqe in ("true", "false"):  # nothing new: a repeated call changes nothing
        before = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        try:
            for name in full:
                incremental.compact(spark, root, name)
            check()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", before)

    rel = Relations(c, p, o, i)
    a = run_batch(rel, scratch_path(spark, "inc-out"), as_of=fx.AS_OF,
                  pre_aggregates=incremental.current_all(spark, root))
    b = run_batch(rel, scratch_path(spark, "full-out"), as_of=fx.AS_OF, share=False)
    for name in a:
        ra = sorted(tuple(r) for r in spark.read.option("header", True).csv(a[name]).collect())
        rb = sorted(tuple(r) for r in spark.read.option("header", True).csv(b[name]).collect())
        assert ra == rb, name


def test_outputs_follow_the_given_pre_aggregates(spark):
    c, p, o, i = fx.frames(spark)
    rel = Relations(c, p, o, i)
    doubled = customer_revenue(o).withColumn("revenue", F.col("revenue") * 2)
    none = {"per_customer": doubled, "parts": time_parts(o).where("false"),
            "per_product": product_sales(i).where("false"), "per_window": window_revenue(o).where("false")}
    for share in (True, False):
        out = run_batch(rel, scratch_path(spark, "altered"), as_of=fx.AS_OF, pre_aggregates=none, share=share)

        def rows(name):
            return spark.read.option("header", True).csv(out[name]).collect()

        assert rows("monthly_sales") == [] and rows("customer_ltv") == [] and rows("category_revenue") == []
        total = sum(r[3] for r in fx.ORDERS)
        assert float(rows("summary_kpis")[0].total_sales_amount) == float(2 * total)
        assert sum(float(r.total_revenue) for r in rows("regional_revenue")) <= float(2 * total)


def test_partials_before_the_last_base_are_removed(spark):
    _c, _p, o, i = fx.frames(spark)
    src, root, ck = scratch_path(spark, "rt-src"), scratch_path(spark, "rt"), scratch_path(spark, "rt-ck")
    _write_in_parts(spark, o, i, src)
    for n in (1, 2, 3):
        _run(spark, src, root, ck, o, i, n)
        incremental.compact(spark, root, "per_customer")
    left = {r.batch_id for r in spark.read.parquet(f"{root}/per_customer/partials").select("batch_id").collect()}
    assert 0 not in left and left
    got = incremental.current(spark, root, "per_customer")
    assert _rows(got, ["customer_id"]) == _rows(customer_revenue(o), ["customer_id"])
