"""Forward look at booked appointments per branch and working day, against budget.

``branches`` has code, fte_100 and fte_85; ``appt_budget`` has branch, fiscal_month (July = 0) and
per_day. Every report has one row per roster branch and day plus a TOTAL row per day.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from lensmill.functions.exprs import MINUTES_PER_FTE, fiscal_month, minute_boundaries, ratio_or_zero
from lensmill.functions.windows import look_ahead, working_days
from lensmill.plans.branch import roster
from lensmill.plans.codes import NOT_BOOKABLE
from lensmill.sources.catalog import Clinic

TOTAL = "TOTAL"
CELLS = ["volume", "minutes", "optometrists"]


def daily_cells(clinic: Clinic, as_of: date, branches: DataFrame, days: int = 21) -> DataFrame:
    """Volume, minutes and optometrist count per day and branch, from one scan of the appointments.

    An optometrist counts at every branch of the day, with any appointment type, if they have at least
    one real appointment somewhere that day.
    """
    window = look_ahead(as_of, days)
    open_days = working_days(window)
    # Each day closes at 23:59:59 sharp, like any report window.
    booked = clinic.within("appointment", "STARTDATE", window).filter(
        "dayofweek(STARTDATE) <> 1"
        " and STARTDATE <= cast(cast(STARTDATE as date) as timestamp_ntz) + interval '23:59:59' hour to second"
    )
    real = F.expr(f"APPOINTMENT_TYPE not in ({NOT_BOOKABLE})")
    per_person = (
        booked.select(
            F.to_date("STARTDATE").alias("day"),
            F.col("RESID").alias("resid"),
            F.col("BRANCH_IDENTIFIER").alias("branch"),
            F.when(real & F.col("ID").isNotNull(), 1).alias("volume"),
            F.when(real, minute_boundaries(F.col("STARTDATE"), F.col("ENDDATE"))).alias("minutes"),
            F.coalesce(real, F.lit(False)).alias("real"),
        )
        .groupBy("day", "resid", "branch")
        .agg(F.sum("volume").alias("volume"), F.sum("minutes").alias("minutes"), F.bool_or("real").alias("real"))
    )
    # At most one row per branch is left for a person and day, so this window stays small.
    anywhere = F.bool_or("real").over(Window.partitionBy("day", "resid"))
    present = F.when(F.col("resid").isNotNull() & anywhere, 1).alias("optometrists")
    booked_cells = (
        per_person.select("day", "branch", "volume", "minutes", present)
        .join(roster(branches), "branch", "left_semi")
        .select("day", F.explode(F.array("branch", F.lit(TOTAL))).alias("branch"), *CELLS)
    )
    # Every branch adds a zero to its own cell and to the total's, so all cells exist.
    empty_cells = (
        roster(branches)
        .select(F.explode(F.array("branch", F.lit(TOTAL))).alias("branch"))
        .select(
            F.explode(F.array(*(F.lit(d) for d in open_days))).alias("day"),
            "branch",
            *(F.lit(0).cast("bigint").alias(c) for c in CELLS),
        )
    )
    return booked_cells.unionByName(empty_cells).groupBy("branch", "day").agg(*(F.sum(c).alias(c) for c in CELLS))


def _fte():
    return F.col("minutes") / F.lit(float(MINUTES_PER_FTE))


def _with_fte_budget(cells: DataFrame, branches: DataFrame) -> DataFrame:
    own = branches.select(F.col("code").alias("branch"), "fte_100", "fte_85")
    total = branches.select(F.lit(TOTAL).alias("branch"), "fte_100", "fte_85")
    budget = own.unionAll(total).groupBy("branch").agg(
        F.sum("fte_100").cast("double").alias("budget_100"), F.sum("fte_85").cast("double").alias("budget_85")
    )
    return cells.join(budget, "branch", "left")


def _with_volume_budget(cells: DataFrame, branches: DataFrame, appt_budget: DataFrame) -> DataFrame:
    own = appt_budget.join(roster(branches), "branch", "left_semi")
    budget = (
        own.select(F.explode(F.array("branch", F.lit(TOTAL))).alias("branch"), "fiscal_month", "per_day")
        .groupBy("branch", "fiscal_month")
        .agg(F.sum("per_day").cast("double").alias("per_day"))
    )
    return cells.withColumn("fiscal_month", fiscal_month(F.col("day"))).join(
        budget, ["branch", "fiscal_month"], "left"
    )


def _fte_vs_budget():
    return F.try_divide(_fte(), F.col("budget_85"))


def _fte_actual():
    """FTE per optometrist: 0 for a branch without any, empty for such a total."""
    people = F.col("optometrists").cast("double")
    return F.when(F.col("branch") == TOTAL, F.try_divide(_fte(), people)).otherwise(ratio_or_zero(_fte(), people))


def _volume_vs_budget():
    return F.try_divide(F.col("volume").cast("double"), F.col("per_day"))


def daily_volume(clinic: Clinic, as_of: date, branches: DataFrame, days: int = 21) -> DataFrame:
    return daily_cells(clinic, as_of, branches, days).select("branch", "day", "volume")


def daily_fte(clinic: Clinic, as_of: date, branches: DataFrame, days: int = 21) -> DataFrame:
    return daily_cells(clinic, as_of, branches, days).select("branch", "day", _fte().alias("fte"))


def daily_fte_vs_budget(clinic: Clinic, as_of: date, branches: DataFrame, days: int = 21) -> DataFrame:
    cells = _with_fte_budget(daily_cells(clinic, as_of, branches, days), branches)
    return cells.select("branch", "day", "budget_100", "budget_85", _fte_vs_budget().alias("fte_vs_budget"))


def daily_optometrists(clinic: Clinic, as_of: date, branches: DataFrame, days: int = 21) -> DataFrame:
    return daily_cells(clinic, as_of, branches, days).select("branch", "day", "optometrists")


def daily_fte_actual(clinic: Clinic, as_of: date, branches: DataFrame, days: int = 21) -> DataFrame:
    return daily_cells(clinic, as_of, branches, days).select("branch", "day", _fte_actual().alias("fte_actual"))


def daily_volume_vs_budget(
    clinic: Clinic, as_of: date, branches: DataFrame, appt_budget: DataFrame, days: int = 21
) -> DataFrame:
    cells = _with_volume_budget(daily_cells(clinic, as_of, branches, days), branches, appt_budget)
    return cells.select("branch", "day", _volume_vs_budget().alias("volume_vs_budget"))


def capacity_report(
    clinic: Clinic, as_of: date, branches: DataFrame, appt_budget: DataFrame, days: int = 21
) -> DataFrame:
    """All six sections as (section, branch, day, value), from one pass."""
    cells = _with_fte_budget(daily_cells(clinic, as_of, branches, days), branches)
    cells = _with_volume_budget(cells, branches, appt_budget)
    wide = cells.select(
        "branch",
        "day",
        F.col("volume").cast("double").alias("volume"),
        _fte().alias("fte"),
        _fte_vs_budget().alias("fte_vs_budget"),
        F.col("optometrists").cast("double").alias("optometrists"),
        _fte_actual().alias("fte_actual"),
        _volume_vs_budget().alias("volume_vs_budget"),
    )
    sections = [c for c in wide.columns if c not in ("branch", "day")]
    return wide.unpivot(["branch", "day"], sections, "section", "value").select("section", "branch", "day", "value")
