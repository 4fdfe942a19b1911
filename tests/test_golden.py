"""A whole report against known tables."""

from __future__ import annotations

import golden
import pytest

from cashcycle import ReportOptions, ReportPeriods, run_report
from cashcycle.operators.cells import daily_totals
from cashcycle.operators.windows import (
    l30_inventory_days,
    monthly_flow_sums,
    period_metrics,
)
from cashcycle.sources.watchlist import watchlist_from_mapping

PERIODS = ReportPeriods(golden.AS_OF)
WATCHLIST = {"testing": ["VN_Supplier_A", "VN_Supplier_B"], "ELSEWHERE": ["X"]}


@pytest.fixture(scope="module")
def mart(spark):
    return spark.createDataFrame(golden.mart_rows(), golden.MART_DDL)


@pytest.fixture(scope="module")
def report(spark, mart):
    options = ReportOptions(calendar_months=True, brand_days=31)
    watchlist = watchlist_from_mapping(spark, WATCHLIST)
    return run_report(mart, golden.AS_OF, watchlist=watchlist, options=options)


def test_tracking(report):
    rows = report["tracking"].drop("grass_region").orderBy("supplier_name").collect()
    assert [tuple(row) for row in rows] == golden.EXPECTED_TRACKING


@pytest.mark.parametrize("name", list(golden.EXPECTED_MATRICES))
def test_matrix(report, name):
    table = report[name]
    days = [day.isoformat() for day in golden.DAYS]
    assert table.columns == ["grass_region", "category_cluster", "supplier_name", *days]
    rows = {row["supplier_name"]: row for row in table.collect()}
    assert len(rows) == 3
    for supplier, runs in golden.EXPECTED_MATRICES[name].items():
        assert [rows[supplier][day] for day in days] == golden.unroll(runs)


def test_watchlist(report):
    listed = [row.supplier_name for row in report["tracking_yaml"].collect()]
    assert sorted(listed) == WATCHLIST["testing"]


def test_sheet_has_metrics_and_days(report):
    sheet = report["sheet_cogs"]
    assert sheet.columns[:6] == [
        "grass_region",
        "category_cluster",
        "supplier_name",
        "cogs_m2",
        "cogs_m1",
        "cogs_m0",
    ]
    row = sheet.where("supplier_name = 'VN_Supplier_A'").first()
    days = [day.isoformat() for day in golden.DAYS]
    assert row.cogs_m2 == sum(row[d] for d in days if d < "2019-08-01")
    assert row.cogs_m0 == sum(row[d] for d in days if d >= "2019-09-01")


@pytest.mark.parametrize(
    ("measure", "prefix"),
    [("cogs_usd", "cogs"), ("inventory_value_usd", "inv"), ("acct_payables_usd", "payable")],
)
def test_trailing_windows(mart, measure, prefix):
    metrics = period_metrics(daily_totals(mart), measure, PERIODS.trailing_windows())
    rows = {row["supplier_name"]: row for row in metrics.collect()}
    for supplier, expected in golden.EXPECTED_TRAILING[prefix].items():
        got = [rows[supplier][f"{prefix}_{k}"] for k in ("m2", "m1", "m0", "m0_30d")]
        assert got == pytest.approx(expected, abs=1e-6)


def test_l30_inventory_days(mart):
    rows = l30_inventory_days(mart, PERIODS).collect()
    got = {row["supplier_name"]: row["l30_inv_days"] for row in rows}
    for supplier, expected in golden.EXPECTED_L30_DAYS.items():
        if expected is None:
            assert got[supplier] is None
        else:
            assert got[supplier] == pytest.approx(expected, abs=1e-6)


def test_monthly_sums_add_up(mart):
    row = monthly_flow_sums(daily_totals(mart), PERIODS).where(
        "supplier_name = 'VN_Supplier_C'"
    )
    row = row.first()
    values = golden.unroll(golden.EXPECTED_MATRICES["cogs"]["VN_Supplier_C"])
    assert (row.cogs_m2, row.cogs_m1, row.cogs_m0) == (
        sum(values[:31]),
        sum(values[31:62]),
        sum(values[62:]),
    )
