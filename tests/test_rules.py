"""Missing values, ties and edge dates."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from marts import AS_OF, by_supplier, mart
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashcycle import ReportPeriods, Span, extract, run_report
from cashcycle.functions.money import total
from cashcycle.functions.periods import CALENDAR
from cashcycle.operators import brands, quality, rows, snapshot, windows
from cashcycle.operators.cells import daily_totals, supplier_day_cells
from cashcycle.operators.matrices import (
    daily_matrices,
    daily_matrix,
    day_metrics,
    matrix_to_long,
    measure_matrix,
)
from cashcycle.operators.watchlist import on_watchlist
from cashcycle.plans.report import ReportOptions
from cashcycle.plans.scorecard import display
from cashcycle.sources.watchlist import WATCHLIST_SCHEMA, watchlist_from_mapping

PERIODS = ReportPeriods(AS_OF)
WINDOWS = PERIODS.inbound_windows()
LAST_30 = Span.trailing(AS_OF, 30)


def days_ago(n: int) -> date:
    return AS_OF - timedelta(days=n)


# --- missing values --------------------------------------------------------------


def test_absent_day_is_not_a_zero_day(spark):
    source = mart(
        spark,
        {"inventory_value_usd": 10.0},
        {"inventory_value_usd": 30.0, "grass_date": days_ago(5)},
    )
    daily = daily_totals(source)
    means = windows.period_means(daily, "inventory_value_usd", PERIODS.trailing_windows())
    assert means.first().inv_m0 == 20.0
    matrix = daily_matrix(daily, "inventory_value_usd", LAST_30).first()
    assert matrix[days_ago(5).isoformat()] == 30.0
    assert matrix[days_ago(4).isoformat()] is None


def test_sum_over_missing_values_is_zero(spark):
    source = mart(spark, {"cogs_usd": None, "stock_on_hand": None})
    daily = daily_totals(source).first()
    assert (daily.cogs_usd, daily.stock_on_hand) == (0.0, 0)
    assert snapshot.inventory_count(source, AS_OF).first().inv_count == 0


def test_no_rows_is_missing_but_no_match_is_zero(spark):
    source = mart(
        spark,
        {"supplier_name": "none in window", "grass_date": date(2019, 8, 1)},
        {"supplier_name": "new sku", "cdate": days_ago(1)},
        {"supplier_name": "old sku", "inbound_value_usd": 7.0},
        {"supplier_name": "old yellow", "color": "Yellow"},
        {"supplier_name": "no value", "inbound_value_usd": None},
    )
    measured = rows.with_replenishment(source, WINDOWS)
    repln = by_supplier(windows.replenishment(measured, WINDOWS))
    green = by_supplier(windows.green_replenishment(measured, WINDOWS))
    assert repln["none in window"].inb_repln_m0_30d is None
    assert repln["new sku"].inb_repln_m0_30d == 0
    assert repln["old sku"].inb_repln_m0_30d == 7
    assert repln["no value"].inb_repln_m0_30d == 0
    assert green["old yellow"].green_repln_m0_30d == 0
    assert green["old sku"].green_repln_m0_30d == 7


def test_missing_creation_date_is_no_replenishment(spark):
    source = mart(spark, {"cdate": None}, {"color": None})
    flags = rows.row_flags(source, WINDOWS).collect()
    assert sorted(row.is_replenishment_m0_30d for row in flags) == [0, 1]
    assert [row.is_green_repln_m0_30d for row in flags] == [0, 0]


def test_missing_category_and_brand_are_not_ranked(spark):
    source = mart(
        spark,
        {"category_cluster": None, "inventory_value_usd": 99.0, "brand": None},
        {"category_cluster": "FMCG", "inventory_value_usd": 1.0, "brand": "nan"},
        {"supplier_name": "T", "category_cluster": None, "brand": None},
        {"supplier_name": "T", "grass_date": days_ago(3), "brand": None},
    )
    category = by_supplier(snapshot.main_category(source))
    assert category["S"].category_cluster == "FMCG"
    assert "T" not in category
    assert brands.brand_counts(source, LAST_30).count() == 0
    tracking = by_supplier(run_report(source, AS_OF, tables=["tracking"])["tracking"])
    for name in ("S", "T"):
        row = tracking[name]
        assert (row.brand_1, row.brand_2, row.brand_3) == ("n.a.",) * 3
    assert tracking["T"].category_cluster is None


def test_ratio_with_zero_or_missing_cogs(spark):
    source = mart(
        spark,
        {"supplier_name": "zero", "cogs_usd": 0.0},
        {"supplier_name": "none", "cogs_usd": None},
        {"supplier_name": "negative", "cogs_usd": -2.0, "inventory_value_usd": 4.0},
    )
    days = by_supplier(windows.working_capital_days(daily_totals(source), PERIODS))
    assert days["zero"].inv_days_m0 is None
    assert days["none"].wc_days_m0 is None
    assert days["negative"].inv_days_m0 == -180.0
    assert days["negative"].wc_days_m0 == -180.0 + 45.0
    assert days["negative"].inv_days_m0_30d == -60.0


def test_scorecard_of_supplier_without_history(spark):
    source = mart(spark, {"cdate": days_ago(1), "color": "Black"})
    report = run_report(source, AS_OF, tables=["scorecard"])
    card = report["scorecard"].first()
    assert card.inb_repln_m2_perc is None
    assert card.inb_repln_m0_30d_perc == 0.0
    assert card.green_repln_m0_30d_perc is None
    assert (card.black_inv_m1, card.black_inv_m0, card.black_inv_m0_perc) == (None, 1, 1)
    assert card.l30_inv_days is None
    shown = display(report["scorecard"]).first()
    assert (shown.inb_repln_m2_perc, shown.black_inv_m0_perc) == ("N/A", "1.0")


# --- extract ---------------------------------------------------------------------


def test_extract_filters(spark):
    source = mart(
        spark,
        {"supplier_name": "kept"},
        {"supplier_name": None},
        {"purchase_type": "Consignment"},
        {"purchase_type": None},
        {"grass_date": days_ago(-1)},
        {"grass_date": PERIODS.extract_span.start - timedelta(days=1)},
        {"supplier_name": "first day", "grass_date": PERIODS.extract_span.start},
        {"supplier_name": "elsewhere", "grass_region": "R2"},
    )
    names = [r.supplier_name for r in extract(source, PERIODS.extract_span).collect()]
    assert sorted(names) == ["elsewhere", "first day", "kept"]
    only = extract(source, PERIODS.extract_span, regions=["R2"])
    assert [r.supplier_name for r in only.collect()] == ["elsewhere"]


def test_same_supplier_name_in_two_regions(spark):
    source = mart(spark, {}, {"grass_region": "R2"}, {"grass_region": "R2"})
    counts = snapshot.sku_count(source, AS_OF).collect()
    assert {r.grass_region: r.no_skus_WH for r in counts} == {"R1": 1, "R2": 2}
    assert snapshot.sku_count_distinct(source, AS_OF).count() == 2


# --- ties and picks --------------------------------------------------------------


def test_main_category_is_taken_on_the_latest_day(spark):
    source = mart(
        spark,
        {"category_cluster": "B", "inventory_value_usd": 5.0},
        {"category_cluster": "A", "inventory_value_usd": 2.0},
        {"category_cluster": "A", "inventory_value_usd": 3.0},
        {"category_cluster": "C", "inventory_value_usd": 90.0, "grass_date": days_ago(1)},
        {"supplier_name": "gone", "category_cluster": "C", "grass_date": days_ago(9)},
    )
    latest = by_supplier(snapshot.main_category(source))
    assert latest["S"].category_cluster == "A"
    assert latest["gone"].category_cluster == "C"
    assert by_supplier(snapshot.latest_date(source))["gone"].grass_date == days_ago(9)
    on_date = by_supplier(snapshot.main_category_snapshot(source, AS_OF))
    assert set(on_date) == {"S"}


def test_brand_ties_are_in_text_order(spark):
    source = mart(
        spark,
        *[{"brand": b, "sku_id": str(n)} for n in range(2) for b in ("z", "a", "m")],
        {"brand": "b"},
        {"brand": "c"},
    )
    counts = brands.brand_counts(source, LAST_30)
    top = brands.top_brands(counts)
    wide = brands.top_brands_wide(top).first()
    assert (wide.brand_1, wide.brand_2, wide.brand_3) == ("a", "m", "z")
    two = brands.brand_counts(source.where("brand <> 'z'"), LAST_30)
    assert [r.brand for r in brands.top_brands(two).orderBy("rank").collect()] == ["a", "m", "b"]
    ranked = brands.top_brands_ranked(two).collect()
    assert sorted((r.rank, r.brand) for r in ranked) == [
        (1, "a"),
        (1, "m"),
        (3, "b"),
        (3, "c"),
    ]


def test_brands_that_share_a_rank_fill_the_places_in_turn(spark):
    def places(**counts):
        table = spark.createDataFrame([("R", "S", b, n) for b, n in counts.items()], "grass_region string, supplier_name string, brand string, n long")
        row = brands.top_brands_wide(brands.top_brands_ranked(table)).first()
        return row.brand_1, row.brand_2, row.brand_3

    assert places(A=3, B=3, C=1) == ("A", "B", "C")
    assert places(z=1, y=5, x=5, w=5, v=5) == ("v", "w", "x")
    assert places(b=2, a=1, c=1, d=1) == ("b", "a", "c")
    assert places(only=1) == ("only", "n.a.", "n.a.")
    assert places(**{f"b{k:03}": 1 for k in range(300)}) == ("b000", "b001", "b002")


def test_copies_count_once_and_only_in_the_window(spark):
    source = mart(
        spark,
        *[{} for _ in range(50)],
        {"sku_id": "2"},
        {"grass_date": days_ago(29)},
        {"grass_date": days_ago(30)},
    )
    assert brands.brand_counts(source, LAST_30).first().n == 3


def test_payment_terms_pick_ignores_missing(spark):
    source = mart(
        spark, {"payment_terms": "7 NET"}, {"payment_terms": None}, {"payment_terms": "30"}
    )
    assert snapshot.payment_terms(source, AS_OF).first().payment_terms == "30"
    cells = supplier_day_cells(source, AS_OF, WINDOWS)
    row = snapshot.snapshot_totals(cells, AS_OF).first()
    assert (row.payment_terms, row.no_skus_WH, row.inv_count) == ("30", 3, 3)


# --- dates -----------------------------------------------------------------------


@pytest.mark.parametrize("as_of", [date(2019, 11, 30), date(2020, 2, 29)])
def test_month_end_window_modes(spark, as_of):
    periods = ReportPeriods(as_of)
    first = as_of.replace(day=1)
    source = mart(
        spark,
        *[{"grass_date": first + timedelta(days=n)} for n in range(-3, as_of.day)],
    )
    rolling = windows.period_sums(source, "inbound_value_usd", periods.inbound_windows())
    whole = windows.period_sums(
        source, "inbound_value_usd", periods.inbound_windows(CALENDAR)
    )
    assert rolling.first().inb_m0_30d == 30
    assert whole.first().inb_m0_30d == as_of.day


def test_overlapping_inbound_windows_count_a_row_in_each(spark):
    as_of = date(2019, 11, 3)
    periods = ReportPeriods(as_of)
    spans = periods.inbound_windows()
    source = mart(spark, {"grass_date": date(2019, 10, 20), "cdate": date(2019, 10, 3)})
    measured = rows.with_replenishment(source, spans)
    row = windows.replenishment(measured, spans).first()
    assert (row.inb_repln_m1, row.inb_repln_m0_30d) == (0, 1)
    sums = windows.period_sums(source, "inbound_value_usd", spans).first()
    assert (sums.inb_m1, sums.inb_m0_30d) == (1, 1)


def test_period_end_without_data(spark):
    source = mart(spark, {}, {"grass_date": date(2019, 9, 30)}, {"grass_region": "R2"})
    coverage = {
        (r.grass_region, r.period): (r.n_rows, r.has_data, r.period_end)
        for r in quality.period_coverage(source, PERIODS).collect()
    }
    assert coverage["R1", "m2"] == (1, True, date(2019, 9, 30))
    assert coverage["R1", "m1"] == (0, False, date(2019, 10, 31))
    assert coverage["R2", "m2"] == (0, False, date(2019, 9, 30))
    eop = by_supplier(windows.eop_inventory(source.where("grass_region = 'R1'"), PERIODS))
    assert (eop["S"].eop_inv_m2, eop["S"].eop_inv_m1, eop["S"].eop_inv_m0) == (1, None, 1)


def test_calendar_period_without_rows_sums_to_zero(spark):
    daily = daily_totals(mart(spark, {}))
    sums = windows.monthly_flow_sums(daily, PERIODS).first()
    means = windows.monthly_stock_means(daily, PERIODS).first()
    assert (sums.cogs_m2, sums.cogs_m0) == (0, 1)
    assert (means.inv_m2, means.inv_m0) == (None, 1)


def test_supplier_absent_on_report_date(spark):
    source = mart(spark, {}, {"supplier_name": "gone", "grass_date": days_ago(40)})
    report = run_report(source, AS_OF, tables=["tracking", "cogs", "sheet_cogs"])
    assert [r.supplier_name for r in report["tracking"].collect()] == ["S"]
    assert set(by_supplier(report["cogs"])) == {"S", "gone"}
    assert by_supplier(report["sheet_cogs"])["gone"].category_cluster == "EL"


# --- watchlist -------------------------------------------------------------------


def test_region_without_list_passes_whole(spark):
    source = mart(
        spark,
        {},
        {"supplier_name": "other"},
        {"grass_region": "R2", "supplier_name": "any"},
        {"grass_region": "R3", "supplier_name": "nobody"},
    )
    watchlist = watchlist_from_mapping(spark, {"R1": ["S", "absent"], "R2": None, "R3": []})
    kept = on_watchlist(rows.supplier_spine(source), watchlist).collect()
    assert sorted((r.grass_region, r.supplier_name) for r in kept) == [
        ("R1", "S"),
        ("R2", "any"),
    ]


def test_empty_watchlist_filters_nothing(spark):
    source = rows.supplier_spine(mart(spark, {}, {"supplier_name": "T"}))
    empty = spark.createDataFrame([], WATCHLIST_SCHEMA)
    assert on_watchlist(source, empty).count() == 2


# --- metrics of the days of a row ------------------------------------------------


@pytest.mark.parametrize("measure", ["cogs_usd", "inventory_value_usd"])
def test_metrics_of_days_equal_those_of_rows(spark, measure):
    source = mart(
        spark,
        *[
            {"supplier_name": f"S{n % 4}", "grass_date": days_ago(n * 7 % 139), measure: n / 4}
            for n in range(60)
            if n % 4 != 3 or n * 7 % 139 > 100
        ],
        {"supplier_name": "S0", measure: None},
    )
    daily, spans = daily_totals(source), PERIODS.trailing_windows()
    wide = daily_matrices(daily, [measure], PERIODS.extract_span)
    for zero in (False, True):
        own = day_metrics(wide, measure, spans, PERIODS.extract_span, zero)
        theirs = windows.period_metrics(daily, measure, spans)
        if zero and measure == "cogs_usd":
            theirs = theirs.fillna(0)
        ours = wide.select("grass_region", "supplier_name", *own)
        assert ours.columns == theirs.columns
        assert sorted(ours.collect()) == sorted(theirs.collect())
    with pytest.raises(ValueError, match="m2"):
        day_metrics(wide, measure, spans, Span.trailing(AS_OF, 100))


def test_two_measures_of_one_grouping(spark):
    source = mart(spark, {"cogs_usd": 2.0}, {"grass_date": days_ago(3), "inbound_value_usd": 5.0}, {"supplier_name": "T", "grass_date": days_ago(40)})
    wide = daily_matrices(daily_totals(source), ["cogs_usd", "inbound_value_usd"], LAST_30)
    for measure in ("cogs_usd", "inbound_value_usd"):
        ours = measure_matrix(wide, measure, LAST_30)
        theirs = daily_matrix(daily_totals(source), measure, LAST_30)
        assert ours.columns == theirs.columns
        assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))


# --- invariants ------------------------------------------------------------------


def test_matrix_and_long_form_agree(spark):
    source = mart(
        spark,
        *[
            {"supplier_name": f"S{n % 3}", "grass_date": days_ago(n % 7), "cogs_usd": float(n)}
            for n in range(60)
        ],
    )
    daily = daily_totals(source)
    back = matrix_to_long(daily_matrix(daily, "cogs_usd", LAST_30), "cogs_usd")
    wanted = daily.select("grass_region", "supplier_name", "grass_date", "cogs_usd")
    assert sorted(back.collect()) == sorted(wanted.collect())


def test_cells_and_rows_give_the_same_tables(spark):
    source = mart(
        spark,
        *[
            {
                "supplier_name": f"S{n % 3}",
                "category_cluster": (None, "A", "B")[n % 3],
                "color": ("Green", "Black", None, "Yellow")[n % 4],
                "cdate": days_ago(n * 3),
                "grass_date": days_ago(n),
                "inbound_value_usd": None if n % 11 == 0 else float(n),
            }
            for n in range(100)
        ],
    )
    cells = supplier_day_cells(source, AS_OF, WINDOWS)
    measured = rows.with_black_inventory(rows.with_replenishment(source, WINDOWS))
    for table in (
        lambda d: daily_totals(d),
        lambda d: windows.replenishment(d, WINDOWS),
        lambda d: windows.green_replenishment(d, WINDOWS),
        lambda d: windows.black_stock(d, PERIODS),
        lambda d: windows.eop_inventory(d, PERIODS),
        lambda d: windows.l30_inventory_days(d, PERIODS),
        lambda d: snapshot.main_category(d),
        lambda d: snapshot.latest_date(d),
    ):
        assert sorted(table(cells).collect()) == sorted(table(measured).collect())
    sums = windows.scorecard_sums(cells, PERIODS, WINDOWS).collect()
    for row in sums:
        for label in WINDOWS:
            if row[f"inb_{label}"] is not None:
                assert row[f"inb_repln_{label}"] <= row[f"inb_{label}"]
                assert row[f"green_repln_{label}"] <= row[f"inb_repln_{label}"]


def with_money(source, text: str, kind: str):
    return source.withColumn("cogs_usd", F.lit(text).cast(kind))


def test_decimals_are_summed_exactly(spark):
    text = "12345678901234.5678"
    source = mart(spark, {}, {}, {"grass_date": days_ago(1)})
    source = with_money(source, text, "decimal(18,4)")
    daily = daily_totals(source, ("cogs_usd",))
    assert dict(daily.dtypes)["cogs_usd"] == "decimal(28,4)"
    assert sorted(row.cogs_usd for row in daily.collect()) == [Decimal(text), 2 * Decimal(text)]
    sums = windows.period_sums(source, "cogs_usd", PERIODS.trailing_windows()).first()
    assert sums.cogs_m0 == 3 * Decimal(text)
    assert sums.cogs_m2 is None


def test_totals_are_exact_beyond_the_digits_of_the_measure(spark):
    text = "99999999999999.9999"
    source = mart(spark, *[{} for _ in range(20)])
    narrow = with_money(source, text, "decimal(18,4)")
    wide = with_money(source, text, "decimal(20,4)")
    for table in (narrow, wide):
        assert daily_totals(table, ("cogs_usd",)).first().cogs_usd == 20 * Decimal(text)


# --- totals of any size, and nothing left out silently -----------------------------


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_beyond_eighteen_digits(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        big = Decimal("60000000000000.0000")
        kind = "decimal(18,4)"
        source = mart(spark, {}, {}).withColumns(
            {"cogs_usd": F.lit(big).cast(kind), "inventory_value_usd": F.lit(-big).cast(kind)}
        )
        daily = daily_totals(supplier_day_cells(extract(source, PERIODS.extract_span), AS_OF, {}))
        row = daily.first()
        assert (row.cogs_usd, row.inventory_value_usd) == (2 * big, -2 * big)
        direct = daily_totals(extract(source, PERIODS.extract_span))
        assert direct.schema["cogs_usd"].dataType == T.DecimalType(28, 4)
        assert direct.first().cogs_usd == 2 * big
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_wide_totals_fail_rather_than_vanish(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        wide = Decimal("9e33")
        rows = spark.createDataFrame([(wide,)] * 20, "x decimal(38,4)")
        with pytest.raises(Exception):
            rows.agg(total(F.col("x")).alias("x")).collect()
        assert rows.limit(1).agg(total(F.col("x")).alias("x")).first().x == wide
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_matrix_adds_rows_of_a_day(spark):
    source = mart(spark, {"cogs_usd": 1.0}, {"cogs_usd": 5.0})
    matrix = daily_matrix(extract(source, PERIODS.extract_span), "cogs_usd", Span(AS_OF, AS_OF))
    assert matrix.first()[AS_OF.isoformat()] == 6


def test_unknown_and_unavailable_tables_are_errors(spark):
    source = mart(spark, {})
    with pytest.raises(ValueError, match="trakcing"):
        run_report(source, AS_OF, tables=["trakcing"])
    with pytest.raises(ValueError, match="scorecard"):
        run_report(source, AS_OF, options=ReportOptions(calendar_months=True), tables=["scorecard"])


def test_rows_without_region_are_left_out(spark):
    source = mart(spark, {"grass_region": None}, {})
    assert extract(source, PERIODS.extract_span).count() == 1


def test_coverage_lists_regions_without_rows(spark):
    report = run_report(mart(spark, {}), AS_OF, ["XX", "R1"], tables=["coverage"])
    found = {(r.grass_region, r.n_rows) for r in report["coverage"].collect()}
    assert ("XX", 0) in found
