"""Reporting windows (inclusive date ranges) derived from an explicit as-of date.

Three windows appear in the reports (D = as-of date):

* ``A`` previous calendar month: first .. last day of the month of D - 1 month
* ``B`` rolling month: D - 1 month .. D - 1 day
* ``C`` rolling month shifted a day: (D - 1 day) - 1 month .. D - 1 day

Month arithmetic clamps the day to the end of the target month
(03-31 minus one month is 02-28), like ``add_months``.  Windows are computed
once on the driver and enter the plan as date literals, so Catalyst folds
them and pushes range filters into the Parquet scan.  ``window_columns``
gives the same windows as column expressions over a column of as-of dates.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ReportingWindow:
    start: date
    end: date

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"empty window {self.start}..{self.end}")

    def contains(self, c: Column) -> Column:
        """``c BETWEEN start AND end`` (NULL stays NULL, i.e. not selected)."""
        return c.between(F.lit(self.start), F.lit(self.end))


@dataclass(frozen=True)
class NoWindow:
    """No restriction at all: also rows whose date is NULL."""

    def contains(self, c: Column) -> Column:
        return F.lit(True)


# The whole book: used where a cohort should hold every loan, not one month's.
WHOLE_BOOK = NoWindow()


def add_months(d: date, n: int) -> date:
    m = d.month - 1 + n
    y, m = d.year + m // 12, m % 12 + 1
    return date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def previous_month(as_of: date) -> ReportingWindow:
    """Window A."""
    p = add_months(as_of, -1)
    return ReportingWindow(p.replace(day=1), p.replace(day=calendar.monthrange(p.year, p.month)[1]))


def rolling_month(as_of: date) -> ReportingWindow:
    """Window B."""
    return ReportingWindow(add_months(as_of, -1), as_of - timedelta(days=1))


def rolling_month_shifted(as_of: date) -> ReportingWindow:
    """Window C."""
    end = as_of - timedelta(days=1)
    return ReportingWindow(add_months(end, -1), end)


WINDOW_KINDS = {"A": previous_month, "B": rolling_month, "C": rolling_month_shifted}


def reporting_window(as_of: date, kind: str) -> ReportingWindow:
    return WINDOW_KINDS[kind](as_of)


def reporting_month(as_of: date) -> str:
    """Label of the run month, ``YYYY-MM-01`` (the month of the run, not of the window)."""
    return as_of.strftime("%Y-%m-01")


def window_columns(as_of: Column, kind: str) -> tuple[Column, Column]:
    """(start, end) of a window as Column expressions over a date column."""
    if kind == "A":
        p = F.add_months(as_of, -1)
        return F.trunc(p, "MM"), F.last_day(p)
    if kind == "B":
        return F.add_months(as_of, -1), F.date_sub(as_of, 1)
    if kind == "C":
        end = F.date_sub(as_of, 1)
        return F.add_months(end, -1), end
    raise ValueError(kind)


def reporting_month_column(as_of: Column) -> Column:
    return F.date_format(as_of, "yyyy-MM-01")
