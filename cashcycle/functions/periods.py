"""Report periods.

A report date fixes three period ends: the ends of the two months before it and
the date itself. :class:`ReportPeriods` holds them as Python dates, so that every
filter built from them is a literal and prunes partitions; the ``Column``
functions below give the same dates for a whole column of report dates.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from cashcycle.schema import DAY

TRAILING_DAYS = 90
SHORT_DAYS = 30

ROLLING_30 = "rolling30"
CALENDAR = "calendar"

#: Suffixes of the period columns; the last inbound window is always 30 days.
PERIODS = ("m2", "m1", "m0")
INBOUND_PERIODS = ("m2", "m1", "m0_30d")


@dataclass(frozen=True)
class Span:
    """An inclusive range of days."""

    start: date
    end: date

    @classmethod
    def trailing(cls, end: date, days: int) -> Span:
        return cls(end - timedelta(days=days - 1), end)

    @classmethod
    def month_of(cls, day: date) -> Span:
        """The month ``day`` lies in, from its first day up to ``day``."""
        return cls(day.replace(day=1), day)

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    def dates(self) -> list[date]:
        return [self.start + timedelta(days=n) for n in range(self.days)]

    def contains(self, day: str = DAY) -> Column:
        """The column ``day`` lies in the span, as a literal range Spark can push down."""
        return F.expr(f"{day} BETWEEN DATE '{self.start}' AND DATE '{self.end}'")


def _is_month_end(day: date) -> bool:
    return (day + timedelta(days=1)).day == 1


@dataclass(frozen=True)
class ReportPeriods:
    """All dates that follow from one report date."""

    as_of: date

    @property
    def last_month_end(self) -> date:
        return self.as_of.replace(day=1) - timedelta(days=1)

    @property
    def ends(self) -> dict[str, date]:
        m1 = self.last_month_end
        m2 = m1.replace(day=1) - timedelta(days=1)
        return dict(zip(PERIODS, (m2, m1, self.as_of)))

    @property
    def extract_span(self) -> Span:
        """Everything the 90-day windows reach back to."""
        return Span(Span.trailing(self.ends["m2"], TRAILING_DAYS).start, self.as_of)

    @property
    def monthly_extract_span(self) -> Span:
        """From the first day of the month before last (calendar-month report)."""
        return Span(self.ends["m2"].replace(day=1), self.as_of)

    def trailing_windows(self) -> dict[str, Span]:
        """90 days to each period end, and 30 days to the report date."""
        windows = {k: Span.trailing(end, TRAILING_DAYS) for k, end in self.ends.items()}
        windows["m0_30d"] = Span.trailing(self.as_of, SHORT_DAYS)
        return windows

    def inbound_windows(self, mode: str = ROLLING_30) -> dict[str, Span]:
        """Windows for inbound and replenishment.

        ``rolling30`` is 30 days to each period end. ``calendar`` takes the whole
        month when the period end is a month end.
        """
        if mode not in (ROLLING_30, CALENDAR):
            raise ValueError(f"unknown month window {mode!r}")
        whole_months = mode == CALENDAR
        return {
            label: Span.month_of(end)
            if whole_months and _is_month_end(end)
            else Span.trailing(end, SHORT_DAYS)
            for label, end in zip(INBOUND_PERIODS, self.ends.values())
        }

    def calendar_windows(self) -> dict[str, Span]:
        """The two whole months before, and the current month or 30 days."""
        ends = self.ends
        current = (
            Span.month_of(self.as_of)
            if _is_month_end(self.as_of)
            else Span.trailing(self.as_of, SHORT_DAYS)
        )
        return {
            "m2": Span.month_of(ends["m2"]),
            "m1": Span.month_of(ends["m1"]),
            "m0": current,
        }

    def last_month_30d(self) -> Span:
        """30 days up to the last completed month end."""
        return Span.trailing(self.last_month_end, SHORT_DAYS)


def month_end_before(day: Column, months: int) -> Column:
    """End of the month that lies ``months`` before the month of ``day``."""
    return F.last_day(F.add_months(day, -months))


def last_completed_month_end(day: Column) -> Column:
    return F.date_sub(F.trunc(day, "MM"), 1)


def trailing_start(day: Column, days: int) -> Column:
    return F.date_sub(day, days - 1)


def calendar_window_start(day: Column) -> Column:
    """First of the month for a month end, otherwise 30 days back."""
    return F.when(day == F.last_day(day), F.trunc(day, "MM")).otherwise(
        trailing_start(day, SHORT_DAYS)
    )


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def days_in_current_period(day: Column) -> Column:
    """Day of the month on a month end, otherwise 30."""
    return F.when(day == F.last_day(day), F.dayofmonth(day)).otherwise(SHORT_DAYS)


def day_text(day: Column | str = DAY) -> Column:
    """A date as ``yyyy-MM-dd``."""
    return (F.col(day) if isinstance(day, str) else day).cast("string")
