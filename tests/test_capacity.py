from datetime import date

import pytest

from lensmill.plans import capacity
from tests.conftest import ts

MONDAY = date(2024, 1, 8)


def visit(id, start, end, where="B0", who="O1", kind="SC"):
    return dict(
        ID=id, STARTDATE=ts(start), ENDDATE=ts(end) if end else None, BRANCH_IDENTIFIER=where, RESID=who, APPOINTMENT_TYPE=kind
    )


@pytest.fixture
def clinic(make_clinic):
    return make_clinic(
        appointment=[
            visit(1, "2024-01-08 09:00:59", "2024-01-08 09:01:01"),
            visit(2, "2024-01-08 10:00:00", "2024-01-08 17:44:00"),
            visit(3, "2024-01-08 12:00:00", "2024-01-08 13:00:00", "B1", "O1", "LUN"),  # at work in B0, lunch in B1
            visit(4, "2024-01-08 12:00:00", "2024-01-08 13:00:00", "B1", "O2", "LUN"),  # no real appointment
            visit(5, "2024-01-08 12:00:00", "2024-01-08 13:00:00", "B1", None),
            visit(6, "2024-01-14 12:00:00", "2024-01-14 13:00:00"),  # a Sunday
            visit(7, "2024-01-08 23:59:59.5", "2024-01-09 00:10:00", "B1", "O3"),  # after the day's last second
            visit(8, "2024-01-28 09:00:00", None, "B1", "O3"),  # the last day is a Sunday
            visit(9, "2024-01-27 23:59:59", None, "B1", "O3"),
            visit(10, "2024-01-29 09:00:00", None, "B1", "O3"),
            visit(11, "2024-01-08 09:00:00", "2024-01-08 10:00:00", "B9", "O2", None),
            visit(12, "2024-01-09 09:00:00", "2024-01-09 10:00:00", "B9", "O4"),  # branch outside the roster
            visit(13, "2024-01-09 11:00:00", "2024-01-09 12:00:00", "B0", "O4", "BRK"),
        ]
    )


def cell(frame, branch, day, column):
    return {(r.branch, r.day): r[column] for r in frame.collect()}[branch, date.fromisoformat(day)]


def test_grid_has_every_branch_and_working_day(clinic, branches):
    frame = capacity.daily_volume(clinic, MONDAY, branches)
    assert frame.count() == 18 * 3
    assert cell(frame, "B0", "2024-01-08", "volume") == 2
    assert cell(frame, "B1", "2024-01-08", "volume") == 1
    assert cell(frame, "TOTAL", "2024-01-08", "volume") == 3
    assert cell(frame, "B1", "2024-01-27", "volume") == 1
    assert cell(frame, "B1", "2024-01-10", "volume") == 0


def test_fte_and_budget(clinic, branches):
    fte = capacity.daily_fte(clinic, MONDAY, branches)
    assert cell(fte, "B0", "2024-01-08", "fte") == 465 / 465
    assert cell(fte, "TOTAL", "2024-01-08", "fte") == 525 / 465
    share = capacity.daily_fte_vs_budget(clinic, MONDAY, branches)
    assert cell(share, "B0", "2024-01-08", "fte_vs_budget") == 1 / 6
    assert cell(share, "TOTAL", "2024-01-08", "budget_85") == 8.0
    assert cell(share, "TOTAL", "2024-01-08", "fte_vs_budget") == 525 / 465 / 8


def test_optometrists_count_at_every_branch_of_the_day(clinic, branches):
    frame = capacity.daily_optometrists(clinic, MONDAY, branches)
    assert cell(frame, "B0", "2024-01-08", "optometrists") == 1
    assert cell(frame, "B1", "2024-01-08", "optometrists") == 1
    assert cell(frame, "TOTAL", "2024-01-08", "optometrists") == 2
    assert cell(frame, "B0", "2024-01-09", "optometrists") == 1  # real appointment at an unknown branch


def test_fte_per_optometrist_guards(clinic, branches):
    frame = capacity.daily_fte_actual(clinic, MONDAY, branches)
    assert cell(frame, "B0", "2024-01-08", "fte_actual") == 1.0
    assert cell(frame, "B0", "2024-01-10", "fte_actual") == 0.0
    assert cell(frame, "TOTAL", "2024-01-10", "fte_actual") is None


def test_volume_against_budget(spark, clinic, branches):
    budget = spark.sql(
        "select * from values ('B0', 6, 4), ('B1', 6, 6), ('B9', 6, 100), ('B0', 7, 1) as t(branch, fiscal_month, per_day)"
    )
    frame = capacity.daily_volume_vs_budget(clinic, MONDAY, branches, budget)
    assert cell(frame, "B0", "2024-01-08", "volume_vs_budget") == 0.5
    assert cell(frame, "TOTAL", "2024-01-08", "volume_vs_budget") == 0.3
    report = capacity.capacity_report(clinic, MONDAY, branches, budget)
    assert report.count() == 6 * 18 * 3
    assert {r.section for r in report.select("section").distinct().collect()} == {
        "volume", "fte", "fte_vs_budget", "optometrists", "fte_actual", "volume_vs_budget",
    }
