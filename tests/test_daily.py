"""Daily runs on kept cells against runs on the whole mart."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from marts import AS_OF, mart
from test_random_mart import MART_DDL, random_rows

from cashcycle import ReportOptions, ReportPeriods, Span, daily_report, run_report
from cashcycle.catalog import queries as catalog
from cashcycle.functions.periods import CALENDAR
from cashcycle.operators import snapshot
from cashcycle.plans import daily
from cashcycle.plans.daily import days_read, refresh
from cashcycle.plans.report import ALL_TABLES


@pytest.fixture(scope="module")
def random_mart(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("daily") / "mart")
    spark.createDataFrame(random_rows(5, 800), MART_DDL).write.parquet(path)
    return spark.read.parquet(path)


def tables_of(report):
    return {name: sorted(map(str, table.collect())) for name, table in report.items()}


@pytest.mark.parametrize(
    "as_of,options",
    [
        (catalog.MID_MONTH.as_of, ReportOptions(sku_sketches=True)),
        (catalog.MONTH_END.as_of, ReportOptions(month_window=CALENDAR, clean_brands=True)),
        (catalog.MID_MONTH.as_of, ReportOptions(brand_days=31, distinct_skus=True, calendar_months=True)),
    ],
    ids=["sketches", "clean brands", "calendar months"],
)
def test_daily_runs_equal_full_runs(spark, random_mart, tmp_path, monkeypatch, as_of, options):
    path = f"{tmp_path}/kept"
    read = []
    monkeypatch.setattr(daily, "refresh", lambda *a: read.append(refresh(*a)))
    wanted = [t for t in ALL_TABLES if not (options.calendar_months and t == "scorecard")]
    daily_report(random_mart, path, as_of - timedelta(days=2), options=options, tables=["cogs"])
    daily_report(random_mart, path, as_of - timedelta(days=1), options=options, tables=["cogs"])
    ours = daily_report(random_mart, path, as_of, options=options, tables=wanted)
    assert [len(days) for days in read[1:]] == [1, 1] and read[2] == [as_of]
    theirs = run_report(random_mart, as_of, options=options, tables=wanted)
    assert {n: t.dtypes for n, t in ours.items()} == {n: t.dtypes for n, t in theirs.items()}
    assert tables_of(ours) == tables_of(theirs)


def test_regions_are_kept_apart(spark, tmp_path):
    path, span = f"{tmp_path}/kept", Span.trailing(AS_OF, 3)
    source = mart(spark, {}, {"grass_region": "R2"}, {"grass_region": "R3"})
    assert refresh(source, path, span, ["R1"]) == span.dates()
    assert days_read(spark, path, span) == days_read(spark, path, span, ["R1", "R2"]) == set()
    assert days_read(spark, path, span, ["R1"]) == set(span.dates())
    assert refresh(source, path, span, ["R1"]) == []
    assert refresh(source, path, span) == span.dates()
    assert days_read(spark, path, span, ["R3"]) == set(span.dates())
    regions = daily.read_kept(source, path, "cells").select("grass_region").distinct().collect()
    assert sorted(r[0] for r in regions) == ["R1", "R2", "R3"]


def test_corrected_days_are_read_again(spark, tmp_path):
    path = f"{tmp_path}/kept"
    yesterday, span = AS_OF - timedelta(days=1), ReportPeriods(AS_OF).extract_span
    first = mart(spark, {"grass_date": yesterday}, {}, {"grass_region": "R2"})
    later = mart(spark, {"grass_date": yesterday, "cogs_usd": 5.0})

    def cogs(again):
        report = daily_report(later, path, AS_OF, tables=["cogs"], again=again)["cogs"]
        return {r.grass_region: (r[str(yesterday)], r[str(AS_OF)]) for r in report.collect()}

    refresh(first, path, span)
    assert cogs(0) == {"R1": (1, 1), "R2": (None, 1)}
    assert cogs(1) == {"R1": (1, None)}
    assert cogs(2) == {"R1": (5, None)}


def test_a_failed_refresh_is_repeated(spark, tmp_path, monkeypatch):
    path, span = f"{tmp_path}/kept", Span(AS_OF, AS_OF)
    monkeypatch.setitem(daily.KEPT, "skus", lambda rows: rows.selectExpr("CAST(raise_error('lost') AS STRING) AS grass_region", "grass_date", "sku_id"))
    with pytest.raises(Exception, match="lost"):
        refresh(mart(spark, {}), path, span)
    monkeypatch.undo()
    assert days_read(spark, path, span) == set()
    assert refresh(mart(spark, {}), path, span) == [AS_OF]


def test_region_names_stay_text(spark, tmp_path):
    path = f"{tmp_path}/kept"
    source = mart(spark, {"grass_region": "007"}, {"grass_region": "a/b=c %"})
    report = daily_report(source, path, AS_OF, tables=["tracking"])["tracking"]
    assert sorted(r.grass_region for r in report.collect()) == ["007", "a/b=c %"]


def test_windows_beyond_the_kept_ages_are_refused(spark):
    from cashcycle.operators.cells import base_cells, cells_from_base

    with pytest.raises(ValueError, match="longer"):
        cells_from_base(base_cells(mart(spark, {})), AS_OF, {"m2": Span.trailing(AS_OF, 40)})


@pytest.mark.parametrize("n", [3, 500, 40000])
def test_sketches_are_near_the_exact_count(spark, n):
    rows = spark.range(2 * n).selectExpr(
        "'R' AS grass_region",
        "'S' AS supplier_name",
        f"date_add(DATE '2019-11-01', CAST(id % 7 AS INT)) AS grass_date",
        f"CAST(id % {n} AS STRING) AS sku_id",
    )
    span = Span(date(2019, 11, 1), date(2019, 11, 7))
    found = snapshot.sku_count_sketched(snapshot.sku_sketches(rows), span).first().no_skus_WH
    assert abs(found - n) <= (0 if n < 100 else 0.05 * n)


def test_supplier_without_skus_counts_none(spark):
    rows = mart(spark, {"sku_id": None})
    on_date = Span(AS_OF, AS_OF)
    assert snapshot.sku_count_sketched(snapshot.sku_sketches(rows), on_date).first().no_skus_WH == 0
