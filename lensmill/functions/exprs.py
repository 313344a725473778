"""Scalar expressions with the semantics the reports need. All built-in, no UDF."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

MINUTES_PER_FTE = 465  # a working day of 7.75 hours


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def months_before(column: Column, months: int) -> Column:
    """Keeps the time of day (``add_months`` would drop it); clamps at month end."""
    return column - F.make_ym_interval(F.lit(0), F.lit(months))


def minute_boundaries(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed, not elapsed minutes: 09:00:59 to 09:01:01 is 1."""
    epoch = ntz("1970-01-01 00:00:00")

    def minute(ts: Column) -> Column:
        return (ts - epoch).cast("interval minute").cast("bigint")

    return minute(end) - minute(start)


def age_on(birth: Column, day: date) -> Column:
    """Calendar age; a birthday on 29 February is not yet reached on the 28th."""
    not_reached = F.month(birth) * 100 + F.dayofmonth(birth) > day.month * 100 + day.day
    return F.lit(day.year) - F.year(birth) - not_reached.cast("int")


def fiscal_month(day: Column) -> Column:
    """Month index within a year that starts in July (July = 0)."""
    return (F.month(day) + 5) % 12


def pad_left(column: Column, width: int, fill: str = "0") -> Column:
    """Pads short values; unlike ``lpad`` it never cuts long ones."""
    return F.when(F.length(column) < width, F.lpad(column, width, fill)).otherwise(column)


def pad_right(column: Column, width: int, fill: str = "~") -> Column:
    return F.when(F.length(column) < width, F.rpad(column, width, fill)).otherwise(column)


def title_case(column: Column) -> Column:
    """A capital after every non-letter: o'brien-smith becomes O'Brien-Smith.

    ``initcap`` only breaks words at blanks, so a marked blank is put after every run of non-letters
    and taken out again.
    """
    mark = "\u0001 "
    words = F.regexp_replace(F.lower(column), r"([^\p{L}]+)", f"$1{mark}")
    return F.replace(F.initcap(words), F.lit(mark), F.lit(""))


def person_key(identifier: Column) -> Column:
    """Opaque key for a person in outgoing mail: SHA-256 of the id as text, lower-case hex."""
    return F.sha2(identifier.cast("string"), 256)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))
