import datetime as dt
from decimal import Decimal as D

import pytest

from salestide.operators import extensions, tables, views
from tests import fixtures as fx


@pytest.fixture(scope="module")
def rel(spark):
    return fx.frames(spark)


def test_customer_ltv_windows_and_ranks(rel):
    c, _p, o, _i = rel
    rows = tables.customer_ltv(o, c, window="10 days", k=2).collect()
    assert [r.rank for r in rows] == [1, 1, 2, 1]
    # epoch-aligned 10-day windows start 2025-04-22, 05-02 and 05-12
    starts = sorted({r.window_start for r in rows})
    assert starts == [dt.datetime(2025, 4, 22), dt.datetime(2025, 5, 2),
                      dt.datetime(2025, 5, 12)]
    for r in rows:
        assert r.window_end - r.window_start == dt.timedelta(days=10)
    may2 = [r for r in rows if r.window_start == dt.datetime(2025, 5, 2)]
    # C4: 135; C2: 90 + 20; C1: 99.99; C3: 76.25 (O8 falls in the 05-12 window)
    assert [(r.customer_id, r.customer_ltv) for r in may2] == [("C4", 135.0), ("C2", 110.0)]


def test_customer_ltv_ties_break_on_id(spark):
    orders = [("O1", "C2", fx.ts("2025-05-03 00:00:00"), D("10.00"), "x", "y"),
              ("O2", "C1", fx.ts("2025-05-03 00:00:00"), D("10.00"), "x", "y"),
              ("O3", "C3", fx.ts("2025-05-03 00:00:00"), D("10.00"), "x", "y")]
    c, _p, o, _i = fx.frames(spark, orders=orders)
    rows = tables.customer_ltv(o, c, k=2).collect()
    assert [r.customer_id for r in rows] == ["C1", "C2"]


def test_customer_ltv_duplicate_customer_rows_fan_out_like_a_join(spark):
    dup = fx.CUSTOMERS + [fx.CUSTOMERS[0]]
    c, _p, o, _i = fx.frames(spark, customers=dup)
    rows = {(r.customer_id, r.window_start): r.customer_ltv
            for r in tables.customer_ltv(o, c).collect()}
    assert rows[("C1", dt.datetime(2025, 4, 22))] == 2 * 50.50


def test_regional_and_membership(rel):
    c, _p, o, _i = rel
    reg = [(r.location, r.total_revenue) for r in tables.regional_revenue(o, c, k=2).collect()]
    # Town C: 334.98, Town A: 50.5 + 99.99 + 76.25 = 226.74, Town B: 110
    assert reg == [("Town C", 334.98), ("Town A", 226.74)]
    mem = [(r.membership_type, r.revenue_generated)
           for r in tables.membership_revenue(o, c).collect()]
    assert mem == [("Gold", 485.47), ("Silver", 110.0), ("Bronze", 76.25)]


def test_dangling_order_customer_is_dropped_by_inner_join(spark):
    orders = fx.ORDERS + [("O9", "C9", fx.ts("2025-05-08 02:00:00"), D("5.00"), "x", "y")]
    c, _p, o, _i = fx.frames(spark, orders=orders)
    reg = dict((r.location, r.total_revenue) for r in tables.regional_revenue(o, c).collect())
    assert sum(reg.values()) == pytest.approx(671.72)
    churn = {r.customer_id for r in tables.churn_risk(o, as_of="2025-06-01").collect()}
    assert "C9" in churn  # churn needs no customer row


def test_sales_by_parts_sum_to_total(rel):
    o = rel[2]
    tot = float(sum(r[3] for r in fx.ORDERS))
    for part in ("month", "weekday", "hour"):
        rows = tables.sales_by(o, part).collect()
        assert sum(r[1] for r in rows) == pytest.approx(tot)
    wd = {r.order_weekday: r.weekday_sales for r in tables.sales_by(o, "weekday").collect()}
    # Thursdays 2025-05-01 and 2025-05-08
    assert wd[5] == pytest.approx(50.50 + 30.50 + 45.75 + 135.00 + 20.00)
    hr = {r.order_hour: r.hourly_sales for r in tables.sales_by(o, "hour").collect()}
    assert hr[2] == pytest.approx(155.0)


def test_top_products_lines_units_and_lookback(rel):
    _c, p, o, i = rel
    got = [(r.name, r.sold_quantity) for r in
           tables.top_products(o, i, p, as_of=fx.AS_OF, lookback="3 hours").collect()]
    # orders since 00:00: O4 (P5), O5 (P5), O6 (P4), O7 (P1), O8 (P3)
    assert got == [("Rug", 2), ("Atlas", 1), ("Lamp", 1), ("Rug", 1)]
    units = [(r.name, r.sold_quantity) for r in tables.top_products(
        o, i, p, as_of=fx.AS_OF, lookback="3 hours", measure="units", k=2).collect()]
    assert units == [("Rug", 5), ("Rug", 3)]
    # inclusive bound: O6 at 02:10 is exactly 50 minutes before 03:00; no
    # upper bound, so the later O8 (Lamp) counts too
    edge = tables.top_products(o, i, p, as_of="2025-05-08 03:00:00", lookback="50 minutes")
    assert [(r.name, r.sold_quantity) for r in edge.collect()] == [
        ("Atlas", 1), ("Lamp", 1), ("Rug", 1)]
    edge = tables.top_products(o, i, p, as_of="2025-05-08 03:00:00.000001",
                               lookback="50 minutes")
    assert [(r.name, r.sold_quantity) for r in edge.collect()] == [("Atlas", 1), ("Lamp", 1)]


def test_top_products_unknown_product_has_null_name(spark):
    items = fx.ITEMS + [("I10", "O8", "P9", 1, D("1.00")), ("I11", "O8", "P9", 1, D("1.00")),
                        ("I12", "O7", "P9", 1, D("1.00"))]
    _c, p, o, i = fx.frames(spark, items=items)
    got = [(r.name, r.sold_quantity) for r in
           tables.top_products(o, i, p, as_of=fx.AS_OF, lookback="3 hours", k=1).collect()]
    assert got == [(None, 3)]


def test_category_revenue_uses_item_price(spark):
    items = fx.ITEMS + [("I10", "O8", "P1", 1, D("7.00"))]  # sold below list price
    _c, p, _o, i = fx.frames(spark, items=items)
    cat = {r.category: r.revenue_generated for r in tables.category_revenue(i, p).collect()}
    assert cat["Books"] == pytest.approx(30.0 + 20.5 + 20.0 + 7.0)


def test_churn_boundaries(rel):
    o = rel[2]
    rows = tables.churn_risk(o, as_of="2025-05-15 00:00:00", min_days=7).collect()
    # last orders: C1 05-03 (12 days), C2 05-08 (7), C3 05-08 (7), C4 05-12 (3)
    assert [(r.customer_id, r.days_since_last_order) for r in rows] == [
        ("C1", 12), ("C2", 7), ("C3", 7)]


def test_views(rel):
    c, p, o, i = rel
    share = views.category_share(tables.category_revenue(i, p)).collect()
    assert sum(r.percent for r in share) == pytest.approx(1.0)
    named = {r.order_weekday: r.weekday for r in
             views.weekday_named(tables.sales_by(o, "weekday")).collect()}
    # 2025-05-01/08 Thu, 05-03 Sat, 05-07 Wed, 05-12 Mon
    assert named == {5: "Thu", 7: "Sat", 4: "Wed", 2: "Mon"}
    mem = views.membership_clean(tables.membership_revenue(o, c)).columns
    assert mem == ["label", "revenue"]


def test_views_drop_null_groups(spark):
    orders = fx.ORDERS + [("O9", "C1", None, D("1.00"), "x", "y")]
    _c, _p, o, _i = fx.frames(spark, orders=orders)
    raw = tables.sales_by(o, "month").collect()
    assert any(r.order_month is None for r in raw)
    clean = views.trend_clean(tables.sales_by(o, "month")).collect()
    assert all(r.order_month is not None for r in clean)


def test_retention_in_period_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    base = dt.datetime(2025, 1, 1)
    orders = []
    for n in range(300):
        cust = f"C{rnd.randrange(25)}"
        when = base + dt.timedelta(seconds=rnd.randrange(0, 200 * 86400))
        orders.append((f"O{n}", cust, when, D("1.00"), "x", "y"))
    # exact-boundary pair: gap of exactly 30 days counts, 30 days + 1 µs does not
    orders += [("E1", "X1", base, D("1"), "x", "y"),
               ("E2", "X1", base + dt.timedelta(days=30), D("1"), "x", "y"),
               ("E3", "X2", base, D("1"), "x", "y"),
               ("E4", "X2", base + dt.timedelta(days=30, microseconds=1), D("1"), "x", "y")]
    _c, _p, o, _i = fx.frames(spark, orders=orders)
    flags = {r.customer_id: r.repeat
             for r in extensions.repeat_within_period(o, "30 days").collect()}
    by = {}
    for _id, cust, when, *_ in orders:
        by.setdefault(cust, []).append(when)
    for cust, times in by.items():
        times.sort()
        want = any(b - a <= dt.timedelta(days=30) for a, b in zip(times, times[1:]))
        assert flags[cust] == want, cust
    assert flags["X1"] is True and flags["X2"] is False


def test_growth_by_period_calendar_previous(rel):
    o = rel[2]
    rows = extensions.growth_by_period(o, unit="day").collect()
    d = {r.period_start.date(): r for r in rows}
    assert d[dt.date(2025, 5, 1)].growth_pct is None
    assert d[dt.date(2025, 5, 3)].prev_sales is None  # 05-02 had no orders
    assert d[dt.date(2025, 5, 8)].growth_pct == pytest.approx(
        ((30.50 + 45.75 + 135.00 + 20.00) - 90.0) / 90.0 * 100)


def test_conversion_rate_and_margin(rel):
    c, p, o, i = rel
    extra = c.select("customer_id").union(c.sparkSession.createDataFrame([("C7",)], "customer_id string"))
    r = extensions.conversion_rate(extra, o).collect()[0]
    assert (r.leads, r.converted, r.conversion_rate_pct) == (5, 4, 80.0)
    m = extensions.gross_margin(i, p).collect()[0]
    assert m.gross_margin_pct == pytest.approx(30.0)


@pytest.mark.parametrize("unit", ["hour", "day", "week", "month", "quarter", "year"])
def test_growth_by_period_units(rel, unit):
    o = rel[2]

    def start(t):
        if unit == "hour":
            return t.replace(minute=0, second=0, microsecond=0)
        d = t.replace(hour=0, minute=0, second=0, microsecond=0)
        if unit == "day":
            return d
        if unit == "week":
            return d - dt.timedelta(days=d.weekday())
        if unit == "month":
            return d.replace(day=1)
        if unit == "quarter":
            return d.replace(day=1, month=3 * ((d.month - 1) // 3) + 1)
        return d.replace(day=1, month=1)

    want = {}
    for r in fx.ORDERS:
        want[start(r[2])] = want.get(start(r[2]), D(0)) + r[3]
    got = {r.period_start: r.sales for r in extensions.growth_by_period(o, unit).collect()}
    assert got == {k: float(v) for k, v in want.items()}
