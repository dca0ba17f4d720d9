"""Property tests: the identities the original golden outputs satisfy,
checked on generated closed data (every order total = Σ its lines)."""

import datetime as dt
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salestide.operators import kpis, tables
from tests import fixtures as fx

BASE = dt.datetime(2025, 5, 1)


@st.composite
def closed_data(draw):
    n_cust = draw(st.integers(1, 6))
    n_prod = draw(st.integers(1, 5))
    customers = [(f"C{k}", f"N{k}", "x", "e", "p", BASE, f"L{k % 3}", ["Gold", "Silver"][k % 2])
                 for k in range(n_cust)]
    prices = [D(draw(st.integers(1, 99999))) / 100 for _ in range(n_prod)]
    products = [(f"P{k}", f"K{k % 2}", f"name{k % 2}", prices[k]) for k in range(n_prod)]
    orders, items = [], []
    for n in range(draw(st.integers(1, 12))):
        when = BASE + dt.timedelta(minutes=draw(st.integers(0, 60 * 24 * 40)))
        lines = draw(st.lists(st.tuples(st.integers(0, n_prod - 1), st.integers(1, 5)),
                              min_size=1, max_size=4))
        total = D(0)
        for j, (pk, q) in enumerate(lines):
            items.append((f"I{n}_{j}", f"O{n}", f"P{pk}", q, prices[pk]))
            total += q * prices[pk]
        orders.append((f"O{n}", f"C{draw(st.integers(0, n_cust - 1))}", when, total, "c", "m"))
    return customers, products, orders, items


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(data=closed_data())
def test_revenue_partitions_agree(spark, data):
    customers, products, orders, items = data
    c, p, o, i = fx.frames(spark, customers, products, orders, items)
    total = sum(r[3] for r in orders)
    assert kpis.total_sales(o).collect()[0][0] == pytest.approx(float(total))
    for df in (tables.category_revenue(i, p), tables.membership_revenue(o, c),
               tables.sales_by(o, "month"), tables.sales_by(o, "weekday"),
               tables.sales_by(o, "hour")):
        assert sum(r[1] for r in df.collect()) == pytest.approx(float(total))
    aov = kpis.average_order_value(o).collect()[0][0]
    assert aov == float(total) / len(orders)
    units = sum(r[3] for r in items)
    turnover = kpis.inventory_turnover(i, p).collect()[0][0]
    assert turnover == pytest.approx(0.7 * float(total) / (units / 2), rel=1e-9)
    ltv = tables.customer_ltv(o, c, k=3).collect()
    by_window = {}
    for r in ltv:
        by_window.setdefault(r.window_start, []).append(r)
        assert r.window_end - r.window_start == dt.timedelta(days=10)
    for rows in by_window.values():
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1))
        vals = [r.customer_ltv for r in rows]
        assert vals == sorted(vals, reverse=True)
