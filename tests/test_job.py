import os

from salestide.plans.job import load_relations, run_batch
from salestide.session import scratch_path
from tests import fixtures as fx

HEADERS = {
    "summary_kpis": "total_orders_count,customers_in_last_3hrs,total_sales_amount,"
                    "total_items_sold,total_products_sold,aov,cac,avg_time,"
                    "percent_repeat_customers,sales_in_last3hrs,growth_rate,inventory_turnover",
    "customer_ltv": "customer_id,name,customer_ltv,rank,window_start,window_end",
    "regional_revenue": "location,total_revenue",
    "membership_revenue": "membership_type,revenue_generated",
    "monthly_sales": "order_month,monthly_sales",
    "weekday_sales": "order_weekday,weekday_sales",
    "hourly_sales": "order_hour,hourly_sales",
    "top_products": "name,sold_quantity",
    "category_revenue": "category,revenue_generated",
    "churn_risk": "customer_id,last_ordered_date,days_since_last_order",
}


def test_batch_job_from_csv(spark):
    c, p, o, i = fx.frames(spark)
    src = scratch_path(spark, "job-src")
    paths = {}
    for name, df in [("customers", c), ("products", p), ("orders", o),
                     ("order_items", i.drop("line_amount"))]:
        paths[name] = f"{src}/{name}"
        df.write.option("header", True).csv(paths[name])
    rel = load_relations(spark, paths)
    out = scratch_path(spark, "job-out")
    written = run_batch(rel, out, as_of=fx.AS_OF, top_lookback="3 hours")
    assert set(written) == set(HEADERS)
    for name, header in HEADERS.items():
        parts = sorted(f for f in os.listdir(written[name]) if f.startswith("part-"))
        assert parts, name
        with open(os.path.join(written[name], parts[0])) as f:
            assert f.readline().strip() == header, name
    with open(os.path.join(written["summary_kpis"],
                           [f for f in os.listdir(written["summary_kpis"])
                            if f.startswith("part-")][0])) as f:
        f.readline()
        values = f.readline().strip().split(",")
    assert values[0] == "8" and values[4] == "5"


def test_command_line_batch_and_refresh(spark):
    from salestide.__main__ import main
    c, p, o, i = fx.frames(spark)
    root = scratch_path(spark, "cli-tables")
    for name, df in [("customers", c), ("products", p), ("orders", o), ("order_items", i)]:
        df.write.parquet(f"{root}/{name}")
    out = scratch_path(spark, "cli-out")
    main(["refresh", "--tables", root, "--out", out, "--checkpoint",
          scratch_path(spark, "cli-ck"), "--every", "availableNow", "--as-of", fx.AS_OF])
    assert sorted(os.listdir(out)) == sorted(HEADERS)
    pre, out_inc = scratch_path(spark, "cli-pre"), scratch_path(spark, "cli-inc")
    main(["refresh", "--tables", root, "--out", out_inc, "--checkpoint",
          scratch_path(spark, "cli-ck2"), "--every", "availableNow", "--as-of", fx.AS_OF,
          "--pre-aggregates", pre])
    main(["compact", "--pre-aggregates", pre])
    assert {"per_customer", "parts", "per_product"} <= set(os.listdir(pre))
    for name in HEADERS:
        a = sorted(tuple(r) for r in spark.read.option("header", True).csv(f"{out}/{name}")
                   .collect())
        b = sorted(tuple(r) for r in spark.read.option("header", True).csv(f"{out_inc}/{name}")
                   .collect())
        assert a == b, name
    csv_root = scratch_path(spark, "cli-csv")
    for name, df in [("customers", c), ("products", p), ("orders", o),
                     ("order_items", i.drop("line_amount"))]:
        df.write.option("header", True).csv(f"{csv_root}/{name}")
    out2 = scratch_path(spark, "cli-batch")
    main(["batch", "--customers", f"{csv_root}/customers", "--products", f"{csv_root}/products",
          "--orders", f"{csv_root}/orders", "--order-items", f"{csv_root}/order_items",
          "--out", out2, "--as-of", fx.AS_OF])
    assert sorted(os.listdir(out2)) == sorted(HEADERS)


def test_versioned_outputs_read_latest_published_run(spark):
    from salestide.sources.results import latest_run, read_result, read_summary
    from salestide.plans.job import Relations
    c, p, o, i = fx.frames(spark)
    out = scratch_path(spark, "versioned")
    assert latest_run(spark, out) is None
    assert read_summary(spark, f"{out}/summary_kpis", latest=True).collect()[0][0] == 0
    first = run_batch(Relations(c, p, o, i), out, as_of=fx.AS_OF, versioned=True)
    fewer = o.where("order_id <> 'O8'")
    second = run_batch(Relations(c, p, fewer, i), out, as_of=fx.AS_OF, versioned=True)
    assert first["summary_kpis"] != second["summary_kpis"]
    assert second["summary_kpis"].endswith("run=" + latest_run(spark, out))
    # a run being written (folders present, not yet published) is never read
    os.makedirs(f"{out}/summary_kpis/run=99999999T999999999999Z-partial")
    assert second["summary_kpis"].endswith("run=" + latest_run(spark, out))
    assert read_summary(spark, f"{out}/summary_kpis", latest=True).collect()[0][0] == 7
    churn_schema = spark.createDataFrame(
        [], "customer_id string, last_ordered_date timestamp_ntz, days_since_last_order int").schema
    assert read_result(spark, f"{out}/churn_risk", churn_schema, latest=True).count() == 0


def test_folder_names(spark):
    from salestide.plans.job import Relations
    c, p, o, i = fx.frames(spark)
    out = scratch_path(spark, "renamed")
    written = run_batch(Relations(c, p, o, i), out, as_of=fx.AS_OF,
                        folder_names={"summary_kpis": "kpi_cards", "churn_risk": "at_risk"})
    assert written["summary_kpis"].endswith("/kpi_cards")
    assert "kpi_cards" in os.listdir(out) and "at_risk" in os.listdir(out)
    assert "customer_ltv" in os.listdir(out)


def test_shared_pre_aggregates_give_the_same_outputs(spark):
    from salestide.plans.job import Relations
    c, p, o, i = fx.frames(spark)
    rel = Relations(c, p, o, i)
    a = run_batch(rel, scratch_path(spark, "shared"), as_of=fx.AS_OF, share=True)
    b = run_batch(rel, scratch_path(spark, "unshared"), as_of=fx.AS_OF, share=False)
    for name in HEADERS:
        ra = sorted(tuple(r) for r in spark.read.option("header", True).csv(a[name]).collect())
        rb = sorted(tuple(r) for r in spark.read.option("header", True).csv(b[name]).collect())
        assert ra == rb, name
