import datetime as dt
import math
from decimal import Decimal as D

import pytest

from salestide.operators import kpis
from tests import fixtures as fx


def one(df):
    rows = df.collect()
    assert len(rows) == 1 and len(rows[0]) == 1
    return rows[0][0]


@pytest.fixture(scope="module")
def rel(spark):
    return fx.frames(spark)


def total(rows):
    return sum(r[3] for r in rows)


def test_counts_and_sums(rel):
    c, p, o, i = rel
    assert one(kpis.total_orders(o)) == 8
    assert one(kpis.total_sales(o)) == float(total(fx.ORDERS))
    assert one(kpis.items_sold(i)) == sum(r[3] for r in fx.ITEMS)
    assert one(kpis.unique_products(i)) == 5
    assert one(kpis.average_order_value(o)) == float(total(fx.ORDERS)) / 8
    assert one(kpis.acquisition_cost(c)) == 50000.0 / 4


def test_order_totals_equal_item_lines():
    # the integrity identity the fixture is built on
    for oid, *_rest, amount, _ch, _pay in [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in fx.ORDERS]:
        lines = sum(q * u for _i, o2, _p, q, u in fx.ITEMS if o2 == oid)
        assert lines == amount, oid


def test_new_customers_window_is_inclusive(rel):
    c = rel[0]
    # as_of - 3h = 2025-05-08 00:00; C3 (00:30) and C4 (01:00) qualify, C2 (22:30) not
    assert one(kpis.new_customers(c, as_of=fx.AS_OF)) == 2
    assert one(kpis.new_customers(c, as_of="2025-05-08 03:30:00.250000")) == 2
    assert one(kpis.new_customers(c, as_of="2025-05-08 03:30:00.250001")) == 1


def test_conversion_delay_rows(rel):
    c, _p, o, _i = rel
    rows = {r.customer_id: r.interval_for_first_order_hour
            for r in kpis.conversion_delay(c, o).collect()}
    # whole seconds, then hours rounded half-up to 2 dp
    assert rows["C1"] == D("2.00")
    assert rows["C2"] == D("0.50")
    assert rows["C3"] == D("0.50")  # 00:30:00.25 -> 00:59:59.9 = 1799 s -> 0.4997 -> 0.50
    assert rows["C4"] == D("1.17")  # 70 min
    avg = one(kpis.avg_conversion_delay(c, o))
    assert avg == pytest.approx(float(D("2.00") + D("0.50") + D("0.50") + D("1.17")) / 4)


def test_retention(rel):
    o = rel[2]
    # C1, C2, C3, C4 each have 2 orders
    assert one(kpis.retention_pct(o)) == 100.0
    assert one(kpis.retention_pct(o, min_orders=3)) == 0.0


def test_sales_window_and_growth(rel):
    o = rel[2]
    # [00:00, ∞): O4 O5 O6 O7 O8 ; [21:00, 00:00): O3
    cur = D("30.50") + D("45.75") + D("135.00") + D("20.00") + D("199.98")
    prev = D("90.00")
    assert one(kpis.sales_window(o, as_of=fx.AS_OF)) == float(cur)
    g = one(kpis.growth_rate(o, as_of=fx.AS_OF))
    assert g == (float(cur - prev) / float(prev)) * 100


def test_growth_zero_base_and_empty(spark, rel):
    o = rel[2]
    # previous period [2025-05-11 20:00, 2025-05-12 02:00) is empty; current has O8
    assert one(kpis.growth_rate(o, as_of="2025-05-12 09:00:00", period="7 hours")) == math.inf
    assert one(kpis.growth_rate(o, as_of="2030-01-01 00:00:00")) == 0.0
    assert one(kpis.sales_window(o, as_of="2030-01-01 00:00:00")) == 0.0


def test_empty_inputs_give_null_ratios(spark):
    c, p, o, i = fx.frames(spark, [], [], [], [])
    assert one(kpis.total_orders(o)) == 0
    assert one(kpis.average_order_value(o)) is None
    assert one(kpis.acquisition_cost(c)) == 0.0
    assert one(kpis.retention_pct(o)) is None
    assert one(kpis.avg_conversion_delay(c, o)) is None
    assert one(kpis.inventory_turnover(i, p)) == 0.0


def test_inventory_turnover_identity(rel):
    _c, p, _o, i = rel
    # item price equals list price here, so turnover = 0.7 * sales / (units / 2)
    sales = sum(q * u for *_x, q, u in fx.ITEMS)
    units = sum(r[3] for r in fx.ITEMS)
    got = one(kpis.inventory_turnover(i, p))
    assert got == pytest.approx(0.7 * float(sales) / (units / 2), rel=1e-12)


def test_inventory_turnover_unmatched_items_add_units_only(spark):
    items = fx.ITEMS + [("I10", "O8", "P9", 4, D("1.00"))]
    _c, p, _o, i = fx.frames(spark, items=items)
    sales = sum(q * u for *_x, q, u in fx.ITEMS)
    units = sum(r[3] for r in items)
    assert one(kpis.inventory_turnover(i, p)) == pytest.approx(
        0.7 * float(sales) / (units / 2), rel=1e-12)


def test_summary_row(rel):
    c, p, o, i = rel
    row = kpis.kpi_summary(c, p, o, i, as_of=fx.AS_OF).collect()
    assert len(row) == 1
    from salestide.schemas import SUMMARY
    assert list(row[0].asDict()) == SUMMARY.names
    r = row[0]
    assert r.total_orders_count == 8 and r.customers_in_last_3hrs == 2
    assert r.total_products_sold == 5 and r.percent_repeat_customers == 100.0


def test_as_of_accepts_datetime(rel):
    c = rel[0]
    assert one(kpis.new_customers(c, as_of=dt.datetime(2025, 5, 8, 3, 0))) == 2
