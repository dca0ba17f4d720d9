"""Results under a hot key: one customer with a third of all orders and one
product with a third of all lines (correctness; the plans are built so the
hot key collapses map-side, see test_plans)."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest

from salestide.operators import extensions, kpis, tables
from tests import fixtures as fx


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    base = dt.datetime(2025, 3, 1)
    customers = [(f"C{k}", f"N{k}", "x", "e", "p", base, f"L{k % 4}", ["Gold", "Silver"][k % 2])
                 for k in range(30)]
    products = [(f"P{k}", f"K{k % 3}", f"name{k}", D(k + 1)) for k in range(20)]
    orders, items = [], []
    for n in range(1500):
        cust = "C0" if n % 3 == 0 else f"C{rnd.randrange(1, 30)}"
        when = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 90))
        total = D(0)
        for j in range(rnd.randrange(1, 4)):
            pk = 0 if rnd.random() < 0.34 else rnd.randrange(1, 20)
            q = rnd.randrange(1, 5)
            items.append((f"I{n}_{j}", f"O{n}", f"P{pk}", q, D(pk + 1)))
            total += q * D(pk + 1)
        orders.append((f"O{n}", cust, when, total, "c", "m"))
    return (customers, products, orders, items), fx.frames(spark, customers, products,
                                                            orders, items)


def test_revenue_by_location_and_category(skewed):
    (customers, products, orders, items), (c, p, o, i) = skewed
    loc = {r[0]: r[6] for r in customers}
    want = {}
    for r in orders:
        want[loc[r[1]]] = want.get(loc[r[1]], D(0)) + r[3]
    got = {r.location: r.total_revenue for r in tables.regional_revenue(o, c, k=10).collect()}
    assert got == {k: float(v) for k, v in want.items()}
    cat = {r[0]: r[1] for r in products}
    want = {}
    for r in items:
        want[cat[r[2]]] = want.get(cat[r[2]], D(0)) + r[3] * r[4]
    got = {r.category: r.revenue_generated for r in tables.category_revenue(i, p).collect()}
    assert got == {k: float(v) for k, v in want.items()}


def test_ltv_and_repeat_under_a_hot_customer(skewed):
    (_customers, _products, orders, items), (c, _p, o, i) = skewed
    ltv = tables.customer_ltv(o, c, k=1).collect()
    assert {r.customer_id for r in ltv} == {"C0"}  # C0 wins every window
    flags = {r.customer_id: r.repeat
             for r in extensions.repeat_within_period(o, "1 day").collect()}
    by = {}
    for r in orders:
        by.setdefault(r[1], []).append(r[2])
    for cust, times in by.items():
        times.sort()
        want = any(b - a <= dt.timedelta(days=1) for a, b in zip(times, times[1:]))
        assert flags[cust] == want, cust
    units = sum(r[3] for r in items)
    assert kpis.items_sold(i).collect()[0][0] == units
