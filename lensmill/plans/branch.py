"""Per-branch reports. ``branches`` is a frame with a ``code`` column: the roster, in report terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lensmill.functions.exprs import months_before
from lensmill.functions.windows import DateRange, Windows, fiscal_year_start, window_for
from lensmill.operators.tally import Fact, Metric, tally
from lensmill.plans.codes import (
    CONTACT_LENSES,
    DONE,
    GLASSES_TYPES,
    LENS_TYPES,
    NOT_A_VISIT,
    REFIT_TYPES,
    RETURN,
    SALE,
    SPECTACLES,
)
from lensmill.sources.catalog import Clinic

BY_BRANCH = {"branch": "BRANCH_IDENTIFIER"}


def roster(branches: DataFrame) -> DataFrame:
    return branches.select(F.col("code").alias("branch"))


def trial_followup(clinic: Clinic, window: DateRange) -> DataFrame:
    """Trial lenses collected in the window and not followed up since, by branch."""
    trials = clinic.within("contact_lens_orders", "COLLECTED_DATE", window).filter(
        "TRIAL_ONLY = 1 and FOLLOWED_UP_DATE is null"
    )
    known = clinic["patient"].select("ID")
    return (
        trials.select("USER_ADDED", "PATIENTID", "BRANCH_IDENTIFIER")
        .join(known, F.col("PATIENTID") == F.col("ID"))
        .select("USER_ADDED", "ID", "BRANCH_IDENTIFIER")
        # Further keys let the sort split a branch that holds most of the rows.
        .orderBy("BRANCH_IDENTIFIER", "USER_ADDED", "ID")
    )


def lens_orders_with_script(clinic: Clinic, window: DateRange, script_months: int) -> DataFrame:
    """Regular lens orders whose script was written at most ``script_months`` before the order."""
    orders = clinic.within("contact_lens_orders", "ORDER_DATE", window).filter(
        "CANCELLED = 0 and TRIAL = 0 and WARRANTY = ''"
    )
    # An order in the window can only use scripts from this range, so older ones need not be shuffled.
    scripts = (
        clinic["contact_rx"]
        .filter(F.col("DATE_ADDED").between(months_before(window.start, script_months), window.end))
        .select(F.col("ID").alias("RX_ID"), "DATE_ADDED")
    )
    recent = F.col("DATE_ADDED").between(months_before(F.col("ORDER_DATE"), script_months), F.col("ORDER_DATE"))
    return orders.join(scripts, (F.col("RX_REFERENCE") == F.col("RX_ID")) & recent, "left_semi")


def cl_orders_vs_exams(
    clinic: Clinic,
    windows: Windows,
    branches: DataFrame,
    script_months: int = 3,
    strict_reference: bool = False,
) -> DataFrame:
    """Contact-lens orders on a recent script next to patients with a completed lens appointment.

    ``strict_reference`` keeps the original's look-up by order count, which never finds the exams.
    """
    orders = lens_orders_with_script(clinic, window_for(windows, "contact_lens_orders"), script_months)
    visits = clinic.within("appointment", "STARTDATE", window_for(windows, "appointment"))
    out = tally(
        [
            Fact(orders, BY_BRANCH, [Metric("cl_cx", "count", of="ID")]),
            Fact(
                visits,
                BY_BRANCH,
                [Metric("cl_ex", "distinct", f"APPOINTMENT_TYPE in ({LENS_TYPES}) and {DONE}")],
                entity="PATIENTID",
            ),
        ],
        roster(branches),
    )
    return out.withColumn("cl_ex", F.lit(0).cast("bigint")) if strict_reference else out


def glasses_customers_vs_exams(
    clinic: Clinic, windows: Windows, branches: DataFrame, strict_reference: bool = False
) -> DataFrame:
    """Glasses buyers less returners next to patients with a completed glasses appointment.

    ``strict_reference`` leaves exams at 0 for a branch without buyers, as the original does.
    """
    lines = clinic.sale_lines(window_for(windows, "invoice")).filter(SPECTACLES)
    visits = clinic.within("appointment", "STARTDATE", window_for(windows, "appointment"))
    bought = f"{SPECTACLES} and {SALE} and DESPENSE_TOTAL > 0"
    out = tally(
        [
            Fact(
                lines,
                BY_BRANCH,
                [
                    Metric("gl_cx", "distinct", bought, less=f"{SPECTACLES} and {RETURN} and DESPENSE_TOTAL < 0"),
                    Metric("buyer_rows", "count", bought, of="ID"),
                ],
                entity="PATIENTID",
            ),
            Fact(
                visits,
                BY_BRANCH,
                [Metric("gl_ex", "distinct", f"APPOINTMENT_TYPE in ({GLASSES_TYPES}) and {DONE}")],
                entity="PATIENTID",
            ),
        ],
        roster(branches),
    )
    if strict_reference:
        out = out.withColumn("gl_ex", F.when(F.col("buyer_rows") > 0, F.col("gl_ex")).otherwise(F.lit(0)))
    return out.select("branch", "gl_cx", F.col("gl_ex").cast("bigint").alias("gl_ex"))


def unique_customers_fy(
    clinic: Clinic, window: DateRange, branches: DataFrame, exclusive: bool = False
) -> DataFrame:
    """Patients invoiced in the window for the first time this fiscal year, by their home branch.

    The earlier range ends at the window's first midnight inclusive, as in the original;
    ``exclusive`` ends it before that instant.
    """
    year = DateRange(fiscal_year_start(window.first), window.last)
    sold = F.col("SALE_DATE")
    earlier = (sold < window.start) if exclusive else (sold <= window.start)
    seen = (
        clinic.within("invoice", "SALE_DATE", year)
        .groupBy("PATIENTID")
        .agg(F.bool_or(earlier).alias("earlier"), F.bool_or(window.covers("SALE_DATE")).alias("now"))
        .filter("now and not earlier")
    )
    home = clinic["patient"].select("ID", "BRANCH_IDENTIFIER")
    new = seen.join(home, F.col("PATIENTID") == F.col("ID"))
    return tally([Fact(new, BY_BRANCH, [Metric("unique_cx", "count", of="PATIENTID")])], roster(branches))


def utilisation(clinic: Clinic, window: DateRange, branches: DataFrame) -> DataFrame:
    """Invoices plus collected spectacles plus collected lenses per branch, patients counted each time."""
    visits = (
        clinic.within("invoice", "SALE_DATE", window)
        .select("PATIENTID", "BRANCH_IDENTIFIER")
        .unionAll(
            clinic.within("spectacle_orders", "COLLECTED_DATE", window).select("PATIENTID", "DELIVERY_BRANCH")
        )
        .unionAll(
            clinic.within("contact_lens_orders", "COLLECTED_DATE", window).select("PATIENTID", "BRANCH_IDENTIFIER")
        )
    )
    return tally([Fact(visits, BY_BRANCH, [Metric("utilisation", "count", of="PATIENTID")])], roster(branches))


# The report's column order.
MASTERDATA_COLUMNS = [
    "appt_px_all",
    "gls_appt_no",
    "cl_appt_no",
    "cx_all",
    "gl_cx_no",
    "cl_cx_no",
    "cl_cx_per_rx",
    "total_appt_no",
    "oct_no",
    "cl_new_fit",
    "cl_refit",
    "unique_cx",
]

PAID_SALE = f"{SALE} and DESPENSE_TOTAL > 0"
VISIT = f"{DONE} and APPOINTMENT_TYPE not in ({NOT_A_VISIT})"

VISIT_METRICS = [
    Metric("appt_px_all", "distinct", VISIT),
    Metric("gls_appt_no", "distinct", f"{DONE} and APPOINTMENT_TYPE in ({GLASSES_TYPES})"),
    Metric("cl_appt_no", "distinct", f"{DONE} and APPOINTMENT_TYPE in ({LENS_TYPES})"),
    Metric("cl_refit", "distinct", f"{DONE} and APPOINTMENT_TYPE in ({REFIT_TYPES})"),
    Metric("total_appt_no", "count", VISIT, of="ID"),
]
INVOICE_METRICS = [Metric("cx_all", "distinct", PAID_SALE), Metric("unique_cx", "distinct")]
LINE_METRICS = [
    Metric("gl_cx_no", "distinct", f"{PAID_SALE} and {SPECTACLES}"),
    Metric("cl_cx_no", "distinct", f"{PAID_SALE} and {CONTACT_LENSES}"),
    Metric("oct_no", "distinct", f"{SALE} and ITEM_BARCODE = 'OCT'"),
    Metric("cl_new_fit", "distinct", f"{SALE} and ITEM_BARCODE = 'LTPRO'"),
]


def branch_masterdata(clinic: Clinic, windows: Windows, branches: DataFrame, script_months: int = 4) -> DataFrame:
    """Twelve base numbers per branch over appointments, invoices, items and lens orders."""
    sales = window_for(windows, "invoice")
    scripted = lens_orders_with_script(clinic, window_for(windows, "contact_lens_orders"), script_months)
    return tally(
        [
            Fact(
                clinic.within("appointment", "STARTDATE", window_for(windows, "appointment")),
                BY_BRANCH,
                VISIT_METRICS,
                entity="PATIENTID",
            ),
            Fact(clinic.within("invoice", "SALE_DATE", sales), BY_BRANCH, INVOICE_METRICS, entity="PATIENTID"),
            Fact(clinic.sale_lines(sales).filter(SALE), BY_BRANCH, LINE_METRICS, entity="PATIENTID"),
            Fact(scripted, BY_BRANCH, [Metric("cl_cx_per_rx", "distinct")], entity="PATIENTID"),
        ],
        roster(branches),
    ).select("branch", *MASTERDATA_COLUMNS)
