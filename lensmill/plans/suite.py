"""Named sets of reports for one date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from lensmill.functions.windows import DateRange, Windows, previous_month, trailing_week, trial_window, window_for
from lensmill.plans import branch, staff
from lensmill.sources.catalog import Clinic


class _StoredLines(Clinic):
    """A clinic whose sale lines of one window are stored already."""

    def __init__(self, clinic: Clinic, window: DateRange, lines: DataFrame):
        super().__init__({})
        self._clinic, self._window, self._lines = clinic, window, lines

    def __getitem__(self, name: str) -> DataFrame:
        return self._clinic[name]

    def sale_lines(self, window: DateRange) -> DataFrame:
        return self._lines if window == self._window else self._clinic.sale_lines(window)


def with_stored_lines(clinic: Clinic, window: DateRange, path: str) -> Clinic:
    """The clinic with the window's invoices and items joined once and written under ``path``, for all reports of a
    suite. The path must be one that all executors see; it stays there for the caller to remove."""
    lines = clinic.sale_lines(window)
    lines.write.parquet(path)
    return _StoredLines(clinic, window, lines.sparkSession.read.schema(lines.schema).parquet(path))


def monthly_suite(
    clinic: Clinic,
    as_of: date,
    branches: DataFrame,
    windows: Windows | None = None,
    dispensers_excluded: Sequence[str] = (),
    optometrists_excluded: Sequence[str] = ("",),
) -> dict[str, DataFrame]:
    """The six monthly reports over the previous month (trials: one to two weeks back)."""
    windows = windows or previous_month(as_of)
    month = window_for(windows, "invoice")
    return {
        "utilisation": branch.utilisation(clinic, month, branches),
        "unique_customers_fy": branch.unique_customers_fy(clinic, month, branches),
        "trial_followup": branch.trial_followup(clinic, trial_window(as_of)),
        "branch_masterdata": branch.branch_masterdata(clinic, windows, branches),
        "dispenser_scorecard": staff.dispenser_scorecard(clinic, windows, branches, dispensers_excluded),
        "optometrist_scorecard": staff.optometrist_scorecard(clinic, windows, optometrists_excluded),
    }


def weekly_suite(
    clinic: Clinic, as_of: date, branches: DataFrame, windows: Windows | None = None
) -> dict[str, DataFrame]:
    """The three weekly reports over the seven days that end on ``as_of``."""
    windows = windows or trailing_week(as_of)
    week = window_for(windows, "invoice")
    return {
        "unique_customers_fy": branch.unique_customers_fy(clinic, week, branches),
        "utilisation": branch.utilisation(clinic, week, branches),
        "branch_masterdata": branch.branch_masterdata(clinic, windows, branches),
    }
