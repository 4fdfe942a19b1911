"""Period dates: Python side, column side and plain calendar facts."""

from __future__ import annotations

from calendar import monthrange
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cashcycle.functions import periods as P
from cashcycle.functions.periods import CALENDAR, ReportPeriods, Span


def test_mid_month():
    periods = ReportPeriods(date(2019, 11, 18))
    assert periods.ends == {
        "m2": date(2019, 9, 30),
        "m1": date(2019, 10, 31),
        "m0": date(2019, 11, 18),
    }
    assert periods.extract_span == Span(date(2019, 7, 3), date(2019, 11, 18))
    assert periods.monthly_extract_span.start == date(2019, 9, 1)
    assert periods.last_month_30d() == Span(date(2019, 10, 2), date(2019, 10, 31))
    assert periods.calendar_windows()["m0"].days == 30


@pytest.mark.parametrize("as_of", [date(2019, 11, 30), date(2020, 2, 29), date(2021, 3, 31)])
def test_month_end(as_of):
    periods = ReportPeriods(as_of)
    assert periods.calendar_windows()["m0"] == Span(as_of.replace(day=1), as_of)
    assert periods.inbound_windows(CALENDAR)["m0_30d"].start == as_of.replace(day=1)
    assert periods.inbound_windows()["m0_30d"].start == as_of - timedelta(days=29)


def test_unknown_window_mode():
    with pytest.raises(ValueError, match="month window"):
        ReportPeriods(date(2020, 1, 1)).inbound_windows("weekly")


@settings(max_examples=300, deadline=None)
@given(st.dates(date(1990, 1, 1), date(2060, 12, 31)))
def test_period_facts(as_of):
    periods = ReportPeriods(as_of)
    m2, m1, m0 = periods.ends.values()
    assert m2 < m1 < m0 == as_of
    for end in (m2, m1):
        assert end.day == monthrange(end.year, end.month)[1]
    assert (as_of.year * 12 + as_of.month) - (m2.year * 12 + m2.month) == 2
    windows = periods.trailing_windows()
    assert [w.days for w in windows.values()] == [90, 90, 90, 30]
    assert min(w.start for w in windows.values()) == periods.extract_span.start
    assert all(w.end <= as_of for w in periods.calendar_windows().values())


def test_columns_agree_with_python(spark):
    days = [date(2019, 1, 1) + timedelta(days=n) for n in range(1900)]
    day = F.col("d")
    rows = (
        spark.createDataFrame([(d,) for d in days], "d date")
        .select(
            day,
            P.month_end_before(day, 2).alias("m2"),
            P.month_end_before(day, 1).alias("m1"),
            P.trailing_start(P.month_end_before(day, 2), 90).alias("start"),
            P.last_completed_month_end(day).alias("last"),
            P.calendar_window_start(day).alias("window"),
            P.days_in_current_period(day).alias("n"),
            P.days_in_month(P.month_end_before(day, 2)).alias("n2"),
            P.day_text(day).alias("text"),
        )
        .collect()
    )
    assert len(rows) == len(days)
    for row in rows:
        periods = ReportPeriods(row.d)
        calendar = periods.calendar_windows()
        assert (row.m2, row.m1) == (periods.ends["m2"], periods.ends["m1"])
        assert row.start == periods.extract_span.start
        assert row.last == periods.last_month_end
        assert row.window == periods.inbound_windows(CALENDAR)["m0_30d"].start
        assert (row.n, row.n2) == (calendar["m0"].days, calendar["m2"].days)
        assert row.text == row.d.isoformat()
