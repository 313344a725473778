"""The reports of all suites from day partials: every fact is scanned and folded once, windows and reports are re-folded."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from lensmill.functions.windows import DateRange, Windows, previous_month, trailing_week, trial_window, window_for
from lensmill.operators.partials import Part, Source, merged_metrics, tally_days, write_days
from lensmill.operators.tally import Fact, Metric
from lensmill.plans import branch, first_purchase, staff
from lensmill.sources.catalog import Clinic

INVOICED = Metric("invoiced", "count", of="PATIENTID")
COLLECTED = Metric("collected", "count", "role = 'collected'", "PATIENTID")
LENSES_COLLECTED = Metric("lenses_collected", "count", of="PATIENTID")


def sources(clinic: Clinic, days: DateRange, script_months: int = 4) -> dict[str, Source]:
    """What the branch master data, utilisation and both scorecards need of each fact in the given days, to their very end."""
    days = DateRange(days.first, days.last + timedelta(days=1))
    lines = Fact(
        clinic.sale_lines(days),
        {"branch": "BRANCH_IDENTIFIER", "added": "USER_ADDED", "optometrist": "USER_IDENTIFIER"},
        merged_metrics(
            branch.LINE_METRICS, staff.SALES, staff.NET_COUNTS, staff.DISCOUNTS, staff.REVENUE, staff.billing_metrics(staff.BILLED_ITEMS)
        ),
        entity="PATIENTID",
        once_per="ID",
    )
    visits = Fact(
        clinic.within("appointment", "STARTDATE", days),
        {"branch": "BRANCH_IDENTIFIER", "resource": "RESID"},
        merged_metrics(branch.VISIT_METRICS, staff.VISITS),
        entity="PATIENTID",
    )
    invoices = Fact(
        clinic.within("invoice", "SALE_DATE", days), branch.BY_BRANCH, [*branch.INVOICE_METRICS, INVOICED], entity="PATIENTID"
    )
    scripted = Fact(
        branch.lens_orders_with_script(clinic, days, script_months), branch.BY_BRANCH, [Metric("cl_cx_per_rx", "distinct")], "PATIENTID"
    )
    # A spectacle order counts on its own day for the people involved, and on the day it is collected.
    people = {"order": "USER_ADDED", "fit": "STAFFFIT", "check": "STAFFCHK", "pack": "STAFFPCK", "deliv": "STAFFDEL"}
    roles = [(F.lit(role), F.col("ORDER_DATE"), F.col("BRANCH_IDENTIFIER"), F.col(column)) for role, column in people.items()]
    roles.append((F.lit("collected"), F.col("COLLECTED_DATE"), F.col("DELIVERY_BRANCH"), F.lit(None).cast("string")))
    names = ("role", "at", "branch", "person")
    each = F.inline(F.array(*(F.struct(*(c.alias(n) for n, c in zip(names, role, strict=True))) for role in roles)))
    either = days.covers("ORDER_DATE") | days.covers("COLLECTED_DATE")
    spectacles = Fact(
        clinic["spectacle_orders"].filter(either).select("ID", "PATIENTID", "WARRANTY", "CANCELLED", each),
        {"branch": "branch", "staff": "person"},
        [*staff.WARRANTY_CANCEL, *staff.ORDER_STAGES, COLLECTED],
    )
    lenses = Fact(clinic.within("contact_lens_orders", "COLLECTED_DATE", days), branch.BY_BRANCH, [LENSES_COLLECTED])
    clock = Fact(clinic.within("clockinout", "TIMESTMP", days), staff.BRANCH_STAFF, [staff.CLOCK])
    priced = Fact(clinic.within("stock_arrival", "ARRIVAL_DATE", days), staff.BRANCH_STAFF, [staff.PRICED])
    exams = Fact(clinic.within("examination", "EXAM_DATE", days), staff.BY_OPTOMETRIST, staff.EXAMS, entity="PATIENT_ID")
    letters = Fact(clinic.within("patient_letters", "DATE_ADDED", days), {"staff": "USER_ADDED"}, staff.LETTERS)
    found = [
        ("lines", lines, "SALE_DATE"),
        ("visits", visits, "STARTDATE"),
        ("invoices", invoices, "SALE_DATE"),
        ("scripted", scripted, "ORDER_DATE"),
        ("spectacles", spectacles, "at"),
        ("lenses", lenses, "COLLECTED_DATE"),
        ("clock", clock, "TIMESTMP"),
        ("priced", priced, "ARRIVAL_DATE"),
        ("exams", exams, "EXAM_DATE"),
        ("letters", letters, "DATE_ADDED"),
    ]
    return {name: Source(name, fact, at) for name, fact, at in found}


# The fact whose window a source's rows lie in.
_WINDOW = {
    "lines": "invoice",
    "visits": "appointment",
    "invoices": "invoice",
    "scripted": "contact_lens_orders",
    "spectacles": "spectacle_orders",
    "lenses": "contact_lens_orders",
    "clock": "clockinout",
    "priced": "stock_arrival",
    "exams": "examination",
    "letters": "patient_letters",
}
_BRANCH, _STAFF = {"branch": "branch"}, {"branch": "branch", "staff": "staff"}


class Cube:
    """Stored days of all sources under ``root``, a folder that all executors see."""

    def __init__(self, spark: SparkSession, clinic: Clinic, root: str, script_months: int = 4):
        self.spark, self.clinic, self.root, self.script_months = spark, clinic, root, script_months

    def update(self, days: DateRange, names: Sequence[str] | None = None) -> None:
        """Folds the days anew, of all sources or the named ones; each day is replaced whole."""
        found = sources(self.clinic, days, self.script_months)
        write_days(self.spark, [found[n] for n in names or found], days, self.root)

    def _part(self, name: str, keys: dict[str, str], metrics: Sequence[Metric], windows: Windows) -> Part:
        window = window_for(windows, _WINDOW[name])
        return Part(sources(self.clinic, window, self.script_months)[name], keys, metrics, window)

    def branch_masterdata(self, windows: Windows, branches: DataFrame) -> DataFrame:
        parts = [
            self._part("visits", _BRANCH, branch.VISIT_METRICS, windows),
            self._part("invoices", _BRANCH, branch.INVOICE_METRICS, windows),
            self._part("lines", _BRANCH, branch.LINE_METRICS, windows),
            self._part("scripted", _BRANCH, [Metric("cl_cx_per_rx", "distinct")], windows),
        ]
        table = tally_days(self.spark, parts, self.root, branch.roster(branches))
        return table.select("branch", *branch.MASTERDATA_COLUMNS)

    def utilisation(self, window: DateRange, branches: DataFrame) -> DataFrame:
        parts = [
            self._part("invoices", _BRANCH, [INVOICED], window),
            self._part("spectacles", _BRANCH, [COLLECTED], window),
            self._part("lenses", _BRANCH, [LENSES_COLLECTED], window),
        ]
        table = tally_days(self.spark, parts, self.root, branch.roster(branches))
        return table.select("branch", F.expr("invoiced + collected + lenses_collected as utilisation"))

    def dispenser_scorecard(self, windows: Windows, branches: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
        by_added = {"branch": "branch", "staff": "added"}
        parts = [
            self._part("lines", by_added, [*staff.SALES, *staff.NET_COUNTS, *staff.DISCOUNTS], windows),
            self._part("spectacles", _STAFF, [*staff.WARRANTY_CANCEL, *staff.ORDER_STAGES], windows),
            self._part("clock", _STAFF, [staff.CLOCK], windows),
            self._part("priced", _STAFF, [staff.PRICED], windows),
        ]
        scores = tally_days(self.spark, parts, self.root, drop_zero=True)
        return staff.of_dispensers(scores, self.clinic, branches, excluded)

    def optometrist_scorecard(self, windows: Windows, excluded: Sequence[str] = ("",)) -> DataFrame:
        parts = [
            self._part("lines", {"staff": "optometrist"}, [*staff.REVENUE, *staff.billing_metrics(staff.BILLED_ITEMS)], windows),
            self._part("visits", {"staff": "resource"}, staff.VISITS, windows),
            self._part("exams", {"staff": "staff"}, staff.EXAMS, windows),
            self._part("clock", {"staff": "staff"}, [staff.CLOCK], windows),
            self._part("letters", {"staff": "staff"}, staff.LETTERS, windows),
        ]
        scores = tally_days(self.spark, parts, self.root, staff.active_optometrists(self.clinic, excluded))
        return scores.select(F.col("staff").alias("optometrist"), *staff.OPTOMETRIST_COLUMNS)


def monthly_suite(
    cube: Cube,
    index: first_purchase.Index,
    as_of: date,
    branches: DataFrame,
    windows: Windows | None = None,
    dispensers_excluded: Sequence[str] = (),
    optometrists_excluded: Sequence[str] = ("",),
) -> dict[str, DataFrame]:
    """The six monthly reports; of the facts only the trials, a list of orders, are read again."""
    windows = windows or previous_month(as_of)
    month = window_for(windows, "invoice")
    return {
        "utilisation": cube.utilisation(month, branches),
        "unique_customers_fy": index.unique_customers(month, branches),
        "trial_followup": branch.trial_followup(cube.clinic, trial_window(as_of)),
        "branch_masterdata": cube.branch_masterdata(windows, branches),
        "dispenser_scorecard": cube.dispenser_scorecard(windows, branches, dispensers_excluded),
        "optometrist_scorecard": cube.optometrist_scorecard(windows, optometrists_excluded),
    }


def weekly_suite(
    cube: Cube, index: first_purchase.Index, as_of: date, branches: DataFrame, windows: Windows | None = None
) -> dict[str, DataFrame]:
    """The three weekly reports."""
    windows = windows or trailing_week(as_of)
    week = window_for(windows, "invoice")
    return {
        "unique_customers_fy": index.unique_customers(week, branches),
        "utilisation": cube.utilisation(week, branches),
        "branch_masterdata": cube.branch_masterdata(windows, branches),
    }
