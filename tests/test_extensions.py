"""Extension KPIs on the hand-made fixture, values computed by hand."""

import pytest

from salestide.operators import extensions
from tests import fixtures as fx


@pytest.fixture(scope="module")
def rel(spark):
    return fx.frames(spark)


def test_customer_distribution_by_gender(rel):
    c = rel[0]
    rows = {r.gender: (r.customer_count, r.percent)
            for r in extensions.customer_distribution(c).collect()}
    assert rows == {"female": (2, 50.0), "male": (2, 50.0)}


def test_totals(rel):
    c, p, _o, _i = rel
    assert extensions.total_customers(c).collect()[0][0] == 4
    assert extensions.total_products(p).collect()[0][0] == 5


def test_top_selling_products_by_units(rel):
    _c, p, _o, i = rel
    rows = [(r.product_id, r.name, r.units_sold)
            for r in extensions.top_selling_products(i, p, k=3).collect()]
    # units: P1 3+2, P4 2+3, P5 2+3, P3 1+2, P2 1 -> ties on 5 broken by id
    assert rows == [("P1", "Atlas", 5), ("P4", "Rug", 5), ("P5", "Rug", 5)]


def test_sales_per_customer(rel):
    o = rel[2]
    rows = {r.customer_id: (r.order_count, r.total_sales, r.avg_order_value)
            for r in extensions.sales_per_customer(o).collect()}
    assert rows["C4"] == (2, 334.98, 334.98 / 2)
    assert rows["C1"] == (2, 150.49, 150.49 / 2)


def test_cac_new_only(rel):
    c = rel[0]
    # C3 and C4 signed up in the 3 hours before as_of
    assert extensions.cac_new_only(c, as_of=fx.AS_OF).collect()[0][0] == 25000.0
    assert extensions.cac_new_only(c, as_of="2030-01-01").collect()[0][0] == 0.0


def test_year_month_and_channel(rel):
    o = rel[2]
    ym = [(r.order_year, r.order_month, r.sales)
          for r in extensions.year_month_trend(o).collect()]
    assert ym == [(2025, 5, pytest.approx(671.72))]
    ch = {(r.sales_channel, r.payment_method): (r.order_count, r.sales)
          for r in extensions.sales_by_channel(o).collect()}
    assert ch[("Online", "UPI")] == (3, pytest.approx(50.50 + 30.50 + 20.00))
    assert sum(v[0] for v in ch.values()) == 8


def test_growth_by_period_with_null_dates_and_amounts(spark):
    rows = [("a", "2031-01-05", "10.00"), ("b", "2031-02-05", None), ("c", "2031-03-05", "5.00"),
            ("d", None, "7.00"), ("e", None, "1.00")]
    o = spark.createDataFrame(rows, "order_id string, d string, m string").selectExpr(
        "order_id", "cast(d as timestamp_ntz) as order_date", "cast(m as decimal(18,2)) as total_amount")
    got = {str(r.period_start)[:7]: (r.sales, r.prev_sales, r.growth_pct)
           for r in extensions.growth_by_period(o).collect()}
    assert got == {"None": (8.0, None, None), "2031-01": (10.0, None, None),
                   "2031-02": (None, 10.0, None), "2031-03": (5.0, None, None)}


def test_repeat_period_must_have_a_fixed_length(spark):
    _c, _p, o, _i = fx.frames(spark)
    with pytest.raises(ValueError, match="fixed length"):
        extensions.repeat_within_period(o, "1 month")
