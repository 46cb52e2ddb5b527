"""Physical-plan checks: pushdown, pruning, map-side limits, single ledger scan, no Python in any plan."""

import re

import pytest

import __spark_entry__ as E

PLANS = {}
FREE_STYLE = ("pipeline",)


def plan(spark, small_dir, name):
    if name not in PLANS:
        df = E.queries()[name](spark, small_dir)
        PLANS[name] = df._jdf.queryExecution().executedPlan().toString() + "\n" + \
            df._jdf.queryExecution().optimizedPlan().toString()
    return PLANS[name]


def test_period_filter_reaches_orders_scan(spark, small_dir):
    p = plan(spark, small_dir, "sales_kpis")
    assert re.search(r"PushedFilters: \[Or\(Or\(And\(GreaterThanOrEqual\(o_orderdate", p)


def scans(spark, small_dir, name):
    """The column lists of the scans in the physical plan."""
    return re.findall(r"FileScan parquet \[([^\]]*)\]", plan(spark, small_dir, name).split("== Optimized")[0])


def test_unneeded_dimensions_are_not_joined(spark, small_dir):
    columns = ",".join(scans(spark, small_dir, "sales_kpis"))
    assert "o_orderdate" in columns and "p_partkey" not in columns and "s_suppkey" not in columns
    assert "c_custkey" not in ",".join(scans(spark, small_dir, "dim_services"))


def test_fee_months_reach_the_scan(spark, small_dir):
    for name in ("financial_kpis", "pl_by_group", "evolution_monthly", "ledger_detail"):
        p = plan(spark, small_dir, name)
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", p), name


def test_first_lines_come_from_a_narrow_plan(spark, small_dir):
    lines = [s for s in scans(spark, small_dir, "sales_facts") if "l_extendedprice" in s]
    assert len(lines) == 2 and sum("l_tax" in s for s in lines) == 1


def test_orphan_keys_join_no_five_tables(spark, small_dir):
    # clients once; professionals as the fact and as the history of two checks (equal plans); occupancy once
    lines = [s for s in scans(spark, small_dir, "orphan_keys") if "l_" in s]
    assert len(lines) <= 5 and not any("l_partkey" in s for s in lines)


def test_recurrence_uses_map_side_group_limit(spark, small_dir):
    assert "WindowGroupLimit" in plan(spark, small_dir, "sales_facts")


def test_ledger_scanned_once_for_statement(spark, small_dir):
    p = plan(spark, small_dir, "pl_statement")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", p)
    ledger_scans = [s for s in scans if "o_orderpriority" in s]
    assert len(ledger_scans) == 1


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_evaluation(spark, small_dir, name):
    if name in ("partition_refresh", "snapshot_latest", "append_replace_roundtrip"):
        pytest.skip("writes to the work folder; covered by test_landing")
    p = plan(spark, small_dir, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p
    # of the training-data operators only the native ones have no Python at all
    if name not in FREE_STYLE and (not name.startswith("op") or name.startswith(("op3_", "op6_", "op10_", "orphan"))):
        assert "MapInArrow" not in p and "MapInPandas" not in p
