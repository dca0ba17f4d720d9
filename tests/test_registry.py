"""Every registered query against its SQL oracle on the smallest stored
tables (the driver repeats this at a larger scale)."""

import os

import pytest

from salestide.plans import catalog
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="stored tables not present")


def test_entry_runs(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_id", "name", "customer_ltv", "rank", "window_start",
                          "window_end"]


def test_every_query_has_an_oracle():
    """The catalogue's queries; operators that SQL cannot express are tested
    against brute force beside their package."""
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == set()
    import __spark_entry__ as entry
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_queries_match_oracles(spark):
    import __spark_entry__ as entry
    con = duck(SF)
    oracles = entry.oracle_sql()
    bad = {}
    for name, fn in catalog.QUERIES.items():
        status, detail, _n, _s = compare(spark, con, name, fn, oracles[name], SF)
        if status != "MATCH":
            bad[name] = (status, detail)
    assert bad == {}


def test_streaming_queries_match_in_another_time_zone(spark):
    """Window alignment and session gaps must not depend on the session
    time zone (daylight saving included)."""
    import __spark_entry__ as entry
    con = duck(SF)
    oracles = entry.oracle_sql()
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        bad = {}
        for name in ("st2_windowed_top_products", "st3_churn_alerts", "st6_windowed_revenue",
                     "t01_customer_ltv", "t06_hourly_sales"):
            status, detail, _n, _s = compare(spark, con, name, entry.queries()[name],
                                             oracles[name], SF)
            if status != "MATCH":
                bad[name] = (status, detail)
        assert bad == {}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_batch_queries_match_with_ansi_off(spark):
    """Results must not depend on ANSI mode (ratios use try_divide, money is
    cast explicitly)."""
    import __spark_entry__ as entry
    con = duck(SF)
    oracles = entry.oracle_sql()
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        bad = {}
        for name, fn in catalog.QUERIES.items():
            if name.startswith(("s0", "st")):
                continue
            status, detail, _n, _s = compare(spark, con, name, fn, oracles[name], SF)
            if status != "MATCH":
                bad[name] = (status, detail)
        assert bad == {}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
