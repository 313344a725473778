"""Reporting windows. Every helper takes ``as_of``; nothing reads the clock."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, functions as F

from lensmill.functions.exprs import ntz


@dataclass(frozen=True)
class DateRange:
    """Whole days ``first`` to ``last``, closed at 23:59:59 sharp on the last day."""

    first: date
    last: date

    def covers(self, column: str | Column) -> Column:
        """Literals carry the cast, so the comparison reaches the file scan."""
        col = F.col(column) if isinstance(column, str) else column
        return col.between(self.start, self.end)

    @property
    def start(self) -> Column:
        return ntz(f"{self.first} 00:00:00")

    @property
    def end(self) -> Column:
        return ntz(f"{self.last} 23:59:59")

    @property
    def months(self) -> tuple[str, str]:
        return f"{self.first:%Y-%m}", f"{self.last:%Y-%m}"


Windows = DateRange | Mapping[str, DateRange]


def window_for(windows: Windows, fact: str) -> DateRange:
    """One range for every fact, or a mapping by fact name with an optional ``default``."""
    if isinstance(windows, DateRange):
        return windows
    return windows[fact] if fact in windows else windows["default"]


def trailing_week(as_of: date) -> DateRange:
    return DateRange(as_of - timedelta(days=6), as_of)


def previous_month(as_of: date) -> DateRange:
    last = as_of.replace(day=1) - timedelta(days=1)
    return DateRange(last.replace(day=1), last)


def trial_window(as_of: date) -> DateRange:
    """One to two weeks back: long enough ago that a follow-up is due."""
    return DateRange(as_of - timedelta(days=14), as_of - timedelta(days=7))


def fiscal_year_start(day: date) -> date:
    return date(day.year if day.month >= 7 else day.year - 1, 7, 1)


def single_day(as_of: date, offset: int = 0) -> DateRange:
    day = as_of + timedelta(days=offset)
    return DateRange(day, day)


def look_ahead(as_of: date, days: int = 21) -> DateRange:
    return DateRange(as_of, as_of + timedelta(days=days - 1))


def working_days(window: DateRange) -> list[date]:
    """The days of the window without Sundays."""
    span = (window.last - window.first).days + 1
    every = (window.first + timedelta(days=n) for n in range(span))
    return [d for d in every if d.weekday() != 6]
