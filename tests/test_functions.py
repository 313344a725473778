from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lensmill.functions import exprs, windows
from tests.conftest import day, ts


def one(spark, column, **values):
    frame = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()), "id")
    return frame.select(column).first()[0]


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("2024-01-01 09:00:59", "2024-01-01 09:01:01", 1),
        ("2024-01-01 09:00:00", "2024-01-01 09:00:59.999", 0),
        ("2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("2024-01-01 09:00:30", "2024-01-01 10:00:29", 60),
        ("2024-01-01 10:00:00", "2024-01-01 09:30:00", -30),
    ],
)
def test_minute_boundaries(spark, a, b, expected):
    assert one(spark, exprs.minute_boundaries(exprs.ntz(a), exprs.ntz(b))) == expected


def test_minute_boundaries_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
    try:
        # The clocks go forward at 02:00 that day.
        gap = exprs.minute_boundaries(exprs.ntz("2020-10-04 01:30:00"), exprs.ntz("2020-10-04 03:30:00"))
        assert one(spark, gap) == 120
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "birth, on, expected",
    [
        ("2004-02-29", "2022-02-28", 17),
        ("2004-02-29", "2022-03-01", 18),
        ("2000-05-05", "2018-05-05", 18),
        ("2000-05-05", "2018-05-04", 17),
    ],
)
def test_age(spark, birth, on, expected):
    assert one(spark, exprs.age_on(F.col("b"), day(on)), b=day(birth)) == expected


@pytest.mark.parametrize(
    "text", ["o'brien-smith", "MARY ANN", "x2y zed", "", "d'Arcy o'neill-3rd", "a.b_c", "Customer#000000001"]
)
def test_title_case_equals_python(spark, text):
    assert one(spark, exprs.title_case(F.col("s")), s=text) == text.title()


@pytest.mark.parametrize("text", ["", "1", "1234567", "12345678", "123456789"])
def test_padding_never_cuts(spark, text):
    assert one(spark, exprs.pad_left(F.col("s"), 8), s=text) == text.rjust(8, "0")
    assert one(spark, exprs.pad_right(F.col("s"), 8), s=text) == text.ljust(8, "~")


def test_months_before_keeps_time_and_clamps(spark):
    back = exprs.months_before(exprs.ntz("2020-05-31 10:11:12"), 3)
    assert one(spark, back) == datetime(2020, 2, 29, 10, 11, 12)


def test_fiscal_month(spark):
    got = [one(spark, exprs.fiscal_month(F.col("d")), d=date(2024, m, 1)) for m in range(1, 13)]
    assert got == [6, 7, 8, 9, 10, 11, 0, 1, 2, 3, 4, 5]


def test_person_key(spark):
    assert one(spark, exprs.person_key(F.lit(12))).startswith("6b51d431df5d")


def test_window_helpers():
    assert windows.trailing_week(date(2020, 3, 3)) == windows.DateRange(date(2020, 2, 26), date(2020, 3, 3))
    assert windows.previous_month(date(2020, 3, 31)) == windows.DateRange(date(2020, 2, 1), date(2020, 2, 29))
    assert windows.previous_month(date(2021, 1, 5)) == windows.DateRange(date(2020, 12, 1), date(2020, 12, 31))
    assert windows.trial_window(date(2020, 3, 15)) == windows.DateRange(date(2020, 3, 1), date(2020, 3, 8))
    assert windows.fiscal_year_start(date(2020, 6, 30)) == date(2019, 7, 1)
    assert windows.fiscal_year_start(date(2020, 7, 1)) == date(2020, 7, 1)
    assert windows.single_day(date(2020, 2, 28), 2) == windows.DateRange(date(2020, 3, 1), date(2020, 3, 1))


def test_look_ahead_skips_sundays():
    ahead = windows.look_ahead(date(2024, 1, 8))
    assert ahead.last == date(2024, 1, 28)
    open_days = windows.working_days(ahead)
    assert len(open_days) == 18 and date(2024, 1, 14) not in open_days


def test_window_ends_at_the_last_whole_second(spark):
    stamps = ["2024-01-01 00:00:00", "2024-01-31 23:59:59", "2024-01-31 23:59:59.5", "2023-12-31 23:59:59"]
    frame = spark.createDataFrame([(ts(s),) for s in stamps], "t timestamp_ntz")
    window = windows.DateRange(date(2024, 1, 1), date(2024, 1, 31))
    assert sorted(r.t for r in frame.filter(window.covers("t")).collect()) == [ts(stamps[0]), ts(stamps[1])]


def test_window_for():
    a, b = windows.trailing_week(date(2020, 1, 8)), windows.trailing_week(date(2021, 1, 8))
    assert windows.window_for(a, "invoice") == a
    assert windows.window_for({"default": a, "appointment": b}, "appointment") == b
    assert windows.window_for({"default": a, "appointment": b}, "invoice") == a
