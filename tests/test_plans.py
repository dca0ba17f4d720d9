"""Plan-shape checks: the scale properties the operators are built for.

Inspects the physical plans of every registered batch query (streaming and
write-through entries are skipped: their plans run inside sinks).
"""

import os
import re

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="stored tables not present")

SKIP_PREFIXES = ("s0", "st")


def _plans(spark):
    from salestide.plans import catalog
    out = {}
    for name, fn in catalog.QUERIES.items():
        if name.startswith(SKIP_PREFIXES):
            continue
        df = fn(spark, SF)
        out[name] = df._jdf.queryExecution().executedPlan().toString()
    return out


@pytest.fixture(scope="module")
def plans(spark):
    return _plans(spark)


def test_no_cartesian_or_nested_loop_joins(plans):
    bad = [n for n, p in plans.items()
           if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert bad == []


def test_no_window_or_sort_over_a_single_partition(plans):
    # a Window/WindowGroupLimit/Sort directly fed by a SinglePartition
    # exchange would put every row into one task
    pat = re.compile(r"(Window|Sort)[^\n]*\n\s*[+:\- ]*Exchange SinglePartition")
    assert [n for n, p in plans.items() if pat.search(p)] == []


def test_top_k_per_window_is_limited_map_side(plans):
    assert "WindowGroupLimit" in plans["t01_customer_ltv"]
    assert "Partial" in plans["t01_customer_ltv"]


def test_global_top_k_is_take_ordered(plans):
    for name in ("t02_regional_revenue", "t07_top_products", "d04_top_selling_products"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_scans_read_only_needed_columns(plans):
    # e.g. the monthly trend reads two order columns, never the whole table
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plans["t04_monthly_sales"])
    assert reads and all(set(r.split(",")) <= {"o_totalprice:double",
                                               "o_orderdate:timestamp_ntz"} for r in reads)
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plans["t08_category_revenue"])
    cols = {c.split(":")[0] for r in reads for c in r.split(",")}
    assert cols == {"l_partkey", "l_extendedprice", "p_partkey", "p_type"}


def test_time_filters_reach_the_scan(plans):
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,",
                     plans["k11_growth_rate"])
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,",
                     plans["t07_top_products"])


def test_facts_are_aggregated_before_the_dimension_join(plans):
    # customer LTV: the orders aggregate (partial_sum) sits below the join
    p = plans["t01_customer_ltv"]
    join = p.find("HashJoin")
    assert join != -1 and p.find("partial_sum", join) != -1


def test_summary_merges_subqueries(plans):
    p = plans["k13_kpi_summary"]
    assert "mergedValue" in p  # scalar subqueries over one relation merged


def test_no_python_in_any_plan(plans):
    # every operator is JVM-side: no row-at-a-time or Arrow Python stages
    markers = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
               "MapInPandas", "PythonUDF")
    assert [n for n, p in plans.items() if any(m in p for m in markers)] == []


def test_summary_scans_each_fact_table_once(spark):
    from salestide.plans import catalog
    df = catalog.QUERIES["k13_kpi_summary"](spark, SF)
    df.collect()  # the final adaptive plan shows what was reused
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    for table, column in (("lineitem", "l_partkey"), ("orders", "o_custkey")):
        scans = {m for m in re.findall(rf"FileScan parquet \[[^\]]*{column}#(\d+)", plan)}
        assert scans, table
    assert final
