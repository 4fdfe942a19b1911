"""Supplier working-capital analytics as Spark jobs.

The public entry points are :func:`cashcycle.plans.report.run_report` for the
whole report and the functions in :mod:`cashcycle.operators` for single tables.
Every function takes and returns lazy DataFrames.
"""

from cashcycle.functions.periods import ReportPeriods, Span
from cashcycle.plans.daily import daily_report
from cashcycle.plans.report import (
    ReportOptions,
    report_on_extract,
    run_report,
    write_report,
)
from cashcycle.sources.mart import extract

__all__ = [
    "ReportOptions",
    "ReportPeriods",
    "Span",
    "daily_report",
    "extract",
    "report_on_extract",
    "run_report",
    "write_report",
]
