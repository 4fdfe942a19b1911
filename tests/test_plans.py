"""The shape of physical plans."""

from __future__ import annotations

import re

import pytest

from cashcycle.catalog import queries as catalog
from cashcycle.operators.cells import supplier_day_cells
from cashcycle.operators.matrices import daily_matrices

QUERIES = catalog.registered()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet .*{table}\.parquet", plan))


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["cogs_trailing"](spark, sf_dir))
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "GreaterThanOrEqual(l_shipdate,1998-07-03T00:00)" in scan
    assert "LessThan(l_shipdate,1998-11-19T00:00)" in scan
    assert "l_tax" not in scan.split("ReadSchema")[1]


def test_unused_dimensions_are_not_joined(spark, sf_dir):
    plan = plan_of(QUERIES["cogs_trailing"](spark, sf_dir))
    assert scans(plan, "lineitem") == 1
    assert scans(plan, "part") == scans(plan, "orders") == 0
    assert scans(plan_of(QUERIES["inventory_trailing"](spark, sf_dir)), "part") == 1


def test_cells_are_one_scan_and_one_combined_shuffle(spark, sf_dir):
    periods = catalog.MID_MONTH
    rows = catalog.extract_rows(spark, sf_dir, catalog.EXTRACT_COLUMNS)
    plan = plan_of(supplier_day_cells(rows, periods.as_of, periods.inbound_windows()))
    assert scans(plan, "lineitem") == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert plan.count("HashAggregate") == 2
    assert "SortAggregate" not in plan


def test_scorecard_reads_the_mart_for_brands_only(spark, sf_dir):
    plan = plan_of(QUERIES["scorecard"](spark, sf_dir))
    assert scans(plan, "lineitem") == 1
    assert plan.count("/cells-") >= 2


@pytest.mark.parametrize("name", ["main_category", "top_brands", "top_brands_ranked"])
def test_rankings_are_cut_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_matrix_needs_no_job_to_find_its_days(spark, sf_dir):
    plan = plan_of(QUERIES["daily_cogs"](spark, sf_dir))
    assert scans(plan, "lineitem") == 1
    assert "pivotfirst" in plan.lower()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_flow_windows_are_one_shuffle(spark, sf_dir):
    for name in ("cogs_trailing", "inbound_trailing", "monthly_flow_sums", "replenishment"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


@pytest.mark.parametrize("name", ["eop_inventory", "black_stock"])
def test_only_the_period_ends_are_read(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert scan.count("Or(") >= 1 or "OR" in scan, scan


def test_consignment_lines_stay_in_the_files(spark, sf_dir):
    plan = plan_of(QUERIES["mart_extract"](spark, sf_dir))
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_returnflag" in scan.split("PushedFilters")[1]


@pytest.mark.parametrize("name", ["sheet_cogs", "sheet_inventory", "monthly_cogs_sheet"])
def test_sheets_have_metrics_and_days_from_one_grouping(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "lineitem" not in plan and plan.count("/cells-") == 2
    assert len(re.findall(r"(SortMerge|BroadcastHash|ShuffledHash)Join", plan)) == 1
    assert plan.count("collect_list(") == plan.count("partial_collect_list(") * 2


def test_coverage_reads_the_cells_only(spark, sf_dir):
    plan = plan_of(QUERIES["report_coverage"](spark, sf_dir))
    assert "lineitem" not in plan and "/cells-" in plan


def test_four_matrices_are_one_shuffle_of_the_daily_totals(spark, sf_dir):
    periods = catalog.MID_MONTH
    daily = catalog.all_daily_totals(spark, sf_dir)
    measures = (catalog.COGS, catalog.INBOUND, catalog.INVENTORY, catalog.PAYABLES)
    before = len(re.findall(r"Exchange hashpartitioning", plan_of(daily)))
    wide = daily_matrices(daily, measures, periods.extract_span)
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(wide))) == before + 1
