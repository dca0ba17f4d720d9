"""The README's usage example on CSV files shaped like the original
consumer's output (one file per topic, a header repeated mid-file)."""

import os

from salestide.operators import tables
from salestide.plans.job import load_relations, run_batch
from salestide.session import scratch_path

FILES = {
    "customers": """customer_id,name,gender,email,phone,signup_date,location,membership_type
C_1,Ann Lee,female,a@x,555,2025-05-07 22:10:00.123456,Town A,Gold
customer_id,name,gender,email,phone,signup_date,location,membership_type
C_2,Bob Ray,male,b@x,556x12,2025-05-08 01:00:00.000001,Town B,Silver
""",
    "products": """product_id,category,name,price
P_1,Books,Atlas,10.5
P_2,Home,Lamp,99.99
""",
    "orders": """order_id,customer_id,order_date,total_amount,sales_channel,payment_method
O_1,C_1,2025-05-08 02:30:00.5,121.0,Online,UPI
O_2,C_2,2025-05-08 02:50:00.25,99.99,In-store,Card
""",
    "order_items": """item_id,order_id,product_id,quantity,unit_price
I_1,O_1,P_1,2,10.5
I_2,O_1,P_2,1,99.99
I_3,O_2,P_2,1,99.99
""",
}


def test_readme_usage(spark):
    root = scratch_path(spark, "usage")
    os.makedirs(f"{root}/in")
    for name, text in FILES.items():
        with open(f"{root}/in/{name}_data.csv", "w") as f:
            f.write(text)
    rel = load_relations(spark, {n: f"{root}/in/{n}_data*.csv" for n in FILES})
    paths = run_batch(rel, f"{root}/out/", as_of="2025-05-08 03:00:00")
    row = spark.read.option("header", True).csv(paths["summary_kpis"]).collect()[0]
    assert row.total_orders_count == "2" and row.customers_in_last_3hrs == "1"
    assert row.cac == "25000.0"              # two customers, the repeated header dropped
    assert row.avg_time == "3.08"            # (4.33 + 1.83) / 2 hours, whole seconds
    assert row.inventory_turnover == "77.343"  # 0.7 * 220.98 / (4 / 2)
    assert row.growth_rate == "Infinity"     # nothing in the previous 3 hours
    ltv = tables.customer_ltv(rel.orders, rel.customers).collect()
    assert [(r.customer_id, r.rank) for r in ltv] == [("C_1", 1), ("C_2", 2)]
    assert str(ltv[0].window_start) == "2025-05-02 00:00:00"  # epoch-aligned 10-day window
