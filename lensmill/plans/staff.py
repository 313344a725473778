"""Per-staff scorecards and the metric groups they are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lensmill.functions.windows import DateRange, Windows, window_for
from lensmill.operators.tally import Fact, Metric, tally
from lensmill.plans.branch import roster
from lensmill.plans.codes import (
    CONTACT_LENSES,
    DONE,
    EITHER,
    LENS_TEACH_TYPES,
    LENS_TYPES,
    NET_AMOUNT,
    RETURN,
    SALE,
    SPECTACLES,
)
from lensmill.sources.catalog import Clinic

# Column types of summed money: line amounts carry four decimals, invoice balances two.
AMOUNT = "decimal(38,4)"
BALANCE = "decimal(38,2)"

# ---- dispensers, per branch -------------------------------------------------------------------

BRANCH_STAFF = {"branch": "BRANCH_IDENTIFIER", "staff": "USER_ADDED"}

SALES = [
    Metric(
        "fr_qty", "sum", f"STOCK_TYPE in (2, 3) and {SALE} and DESPENSE_TOTAL > 0 and ITEM_BARCODE <> '0001'", "QTY"
    ),
    Metric("fr_amt", "sum", f"STOCK_TYPE = 2 and {EITHER}", NET_AMOUNT, type=AMOUNT),
    Metric("lens_qty", "sum", f"STOCK_TYPE = 4 and {EITHER} and left(ITEM_BARCODE, 3) <> 'GAP'", "QTY"),
    Metric("lens_amt", "sum", f"STOCK_TYPE = 4 and {EITHER}", NET_AMOUNT, type=AMOUNT),
    Metric("suns_qty", "sum", f"STOCK_TYPE = 3 and {EITHER} and DISCOUNTID <> 106", "QTY"),
    Metric("suns_amt", "sum", f"STOCK_TYPE = 3 and {EITHER}", NET_AMOUNT, type=AMOUNT),
    Metric("own_fr", "sum", f"ITEM_BARCODE = '0001' and {EITHER}", "QTY"),
    Metric("lens_ng", "sum", f"left(ITEM_BARCODE, 2) = 'NG' and {EITHER}", "QTY"),
    Metric("unpaid", "sum", EITHER, "STOCK_CHARGED - STOCK_PAID", type=BALANCE),
]
# The report adds an invoice's open balance once per item; this counts it once.
UNPAID_ONCE = Metric("unpaid_per_invoice", "sum_once", EITHER, "STOCK_CHARGED - STOCK_PAID", type=BALANCE)
# The discount numbers and barcodes in these conditions are fixed values.
NET_COUNTS = [
    Metric("cust", "distinct", f"{SPECTACLES} and {SALE} and DESPENSE_TOTAL > 0"),
    Metric("sale", "once", f"{SALE} and {SPECTACLES}", less=f"{RETURN} and {SPECTACLES}"),
    Metric("own_fr_cx", "distinct", f"ITEM_BARCODE = '0001' and {SALE}", less=f"ITEM_BARCODE = '0001' and {RETURN}"),
    Metric("px_2pr", "distinct", f"{SALE} and DISCOUNTID in (26, 74, 75, 97, 105)"),
]


def _given(name: str, condition: str) -> Metric:
    """Discount on sales less discount on returns."""
    less = f"{condition} and {RETURN}"
    return Metric(name, "sum", f"{condition} and {SALE}", "DISCOUNT_AMOUNT", less, AMOUNT)


# Discount numbers (fixed values).
DISCOUNTS = [
    _given("mgmt_d", "DISCOUNTID = 71"),
    _given("match_d", "DISCOUNTID in (77, 89)"),
    _given("total_d", SPECTACLES),
]
WARRANTY_CANCEL = [
    Metric("remake", "count", "role = 'order' and WARRANTY = 'P'", "ID"),
    Metric("wrty", "count", "role = 'order' and WARRANTY in ('S', 'P')", "ID"),
    Metric("cncl", "count", "role = 'order' and CANCELLED = 1", "ID"),
]
ORDER_STAGES = [Metric(stage, "count", f"role = '{stage}'", "ID") for stage in ("fit", "check", "pack", "deliv")]
CLOCK = Metric("w_days", "count", of="TIMESTMP")
CLOCK_DAYS = Metric("w_days_distinct", "distinct")
PRICED = Metric("priced", "count", of="ID")

# The scorecard's column order.
DISPENSER_COLUMNS = [
    "cust",
    "sale",
    "fr_qty",
    "fr_amt",
    "lens_qty",
    "lens_amt",
    "suns_qty",
    "suns_amt",
    "own_fr",
    "own_fr_cx",
    "lens_ng",
    "mgmt_d",
    "match_d",
    "total_d",
    "unpaid",
    "remake",
    "w_days",
    "wrty",
    "cncl",
    "px_2pr",
    "fit",
    "check",
    "pack",
    "deliv",
    "priced",
]


def _staff(identifier_types: str, clinic: Clinic, excluded: Sequence[str]) -> DataFrame:
    active = clinic["users"].filter(f"USER_TYPE in ({identifier_types}) and INACTIVE = 0")
    if excluded:
        active = active.filter(~F.col("IDENTIFIER").isin(*excluded))
    return active.select(F.col("IDENTIFIER").alias("staff")).distinct()


def active_dispensers(clinic: Clinic, excluded: Sequence[str] = ()) -> DataFrame:
    """Active users of the dispensing types, less an exclusion list."""
    return _staff("2, 4, 5", clinic, excluded)


def active_optometrists(clinic: Clinic, excluded: Sequence[str] = ("",)) -> DataFrame:
    """Active optometrists, less an exclusion list (the blank code always belongs on it)."""
    return _staff("1", clinic, excluded)


def _line_fact(clinic: Clinic, window: DateRange, metrics: Sequence[Metric]) -> Fact:
    kinds = {m.kind for m in metrics}
    return Fact(
        clinic.sale_lines(window).filter(EITHER),
        BRANCH_STAFF,
        metrics,
        entity="PATIENTID" if "distinct" in kinds else None,
        once_per="ID" if kinds & {"once", "sum_once"} else None,
    )


def _order_fact(clinic: Clinic, window: DateRange, metrics: Sequence[Metric]) -> Fact:
    """Each spectacle order once per person involved: who took it, fitted, checked, packed, delivered."""
    people = {"order": "USER_ADDED", "fit": "STAFFFIT", "check": "STAFFCHK", "pack": "STAFFPCK", "deliv": "STAFFDEL"}
    roles = {role: col for role, col in people.items() if any(f"role = '{role}'" in m.where for m in metrics)}
    pairs = F.array(*(F.struct(F.lit(role).alias("role"), F.col(col).alias("person")) for role, col in roles.items()))
    orders = clinic.within("spectacle_orders", "ORDER_DATE", window).select(
        "ID", "BRANCH_IDENTIFIER", "WARRANTY", "CANCELLED", F.inline(pairs)
    )
    return Fact(orders, {"branch": "BRANCH_IDENTIFIER", "staff": "person"}, metrics)


def _clock_fact(clinic: Clinic, window: DateRange, keys: dict[str, str], metrics: Sequence[Metric]) -> Fact:
    distinct = any(m.kind == "distinct" for m in metrics)
    events = clinic.within("clockinout", "TIMESTMP", window)
    return Fact(events, keys, metrics, entity="cast(TIMESTMP as date)" if distinct else None)


def _priced_fact(clinic: Clinic, window: DateRange) -> Fact:
    return Fact(clinic.within("stock_arrival", "ARRIVAL_DATE", window), BRANCH_STAFF, [PRICED])


def staff_sales(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_line_fact(clinic, window, [*SALES, UNPAID_ONCE])])


def staff_net_counts(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_line_fact(clinic, window, NET_COUNTS)])


def staff_discounts(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_line_fact(clinic, window, DISCOUNTS)])


def staff_order_stages(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_order_fact(clinic, window, ORDER_STAGES)])


def staff_warranty_cancel(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_order_fact(clinic, window, WARRANTY_CANCEL)])


def staff_clock_days(clinic: Clinic, window: DateRange) -> DataFrame:
    """Clock events per person (the report's figure) and the number of days with one."""
    return tally([_clock_fact(clinic, window, BRANCH_STAFF, [CLOCK, CLOCK_DAYS])])


def staff_priced(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_priced_fact(clinic, window)])


def dispenser_scorecard(
    clinic: Clinic, windows: Windows, branches: DataFrame, excluded: Sequence[str] = ()
) -> DataFrame:
    """25 metrics per branch and active dispenser; people without any non-zero metric are left out."""
    scores = tally(
        [
            _line_fact(clinic, window_for(windows, "invoice"), [*SALES, *NET_COUNTS, *DISCOUNTS]),
            _order_fact(clinic, window_for(windows, "spectacle_orders"), [*WARRANTY_CANCEL, *ORDER_STAGES]),
            _clock_fact(clinic, window_for(windows, "clockinout"), BRANCH_STAFF, [CLOCK]),
            _priced_fact(clinic, window_for(windows, "stock_arrival")),
        ],
        drop_zero=True,
    )
    return of_dispensers(scores, clinic, branches, excluded)


def of_dispensers(scores: DataFrame, clinic: Clinic, branches: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """The scorecard's rows and columns of a tally per branch and person."""
    return (
        scores.join(roster(branches), "branch", "left_semi")
        .join(active_dispensers(clinic, excluded), "staff", "left_semi")
        .select("branch", F.col("staff").alias("dispenser"), *DISPENSER_COLUMNS)
    )


# ---- optometrists, all branches ---------------------------------------------------------------

BY_OPTOMETRIST = {"staff": "USER_IDENTIFIER"}

REVENUE = [
    Metric("cl_cx", "distinct", f"{SALE} and {CONTACT_LENSES}", less=f"{RETURN} and {CONTACT_LENSES}"),
    Metric("cl_amt", "sum", f"{CONTACT_LENSES} and {EITHER}", NET_AMOUNT, type=AMOUNT),
    Metric("lens_qty", "sum", f"STOCK_TYPE = 4 and {EITHER} and left(ITEM_BARCODE, 3) <> 'GAP'", "QTY"),
    Metric("lens_amt", "sum", f"STOCK_TYPE = 4 and {EITHER}", NET_AMOUNT, type=AMOUNT),
    Metric("cons_amt", "sum", "DESPENSE_TOTAL = 0 and ORDER_TYPE = 0", NET_AMOUNT, type=AMOUNT),
]

# Item codes billed per metric (fixed values).
BILLED_ITEMS: dict[str, tuple[str, ...]] = {
    "item_910_11": ("10900", "10911"),
    "item_912_14": ("10912", "10913", "10914"),
    "item_916_18": ("10916", "10918"),
    "item_940_41": ("10940", "10941"),
}
# Letter descriptions per metric (fixed values).
LETTER_KINDS: dict[str, tuple[str, ...]] = {
    "tmpl": ("Treatment Plan", "CL Treatment Plan"),
    "amd": ("Checklist - AMD Referral", "AMD", "Amd"),
    "cat": ("Checklist - Cataract Referral", "CAT", "Cat"),
    "lasik": ("Checklist - Lasik", "LASIK", "Lasik"),
}


def _in(column: str, values: Sequence[str]) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


VISITS = [
    Metric("cl_appt", "count", f"{DONE} and APPOINTMENT_TYPE in ({LENS_TYPES})", "ID"),
    Metric("lt_appt", "count", f"{DONE} and APPOINTMENT_TYPE in ({LENS_TEACH_TYPES})", "ID"),
]
EXAMS = [Metric("upx", "distinct"), Metric("ex", "count", of="ID")]
LETTERS = [Metric(name, "count", _in("LETTER_DESCRIPTION", kinds), "ID") for name, kinds in LETTER_KINDS.items()]

OPTOMETRIST_COLUMNS = [
    "cl_cx",
    "cl_amt",
    "cl_appt",
    "lt_appt",
    "lens_qty",
    "lens_amt",
    "upx",
    "ex",
    "cons_amt",
    "w_days",
    "item_910_11",
    "item_912_14",
    "item_916_18",
    "item_940_41",
    "tmpl",
    "amd",
    "cat",
    "lasik",
]


def billing_metrics(items: dict[str, tuple[str, ...]]) -> list[Metric]:
    return [Metric(name, "sum", _in("ITEM_BARCODE", codes), "QTY") for name, codes in items.items()]


def _optometrist_lines(clinic: Clinic, window: DateRange, metrics: Sequence[Metric]) -> Fact:
    distinct = any(m.kind == "distinct" for m in metrics)
    lines = clinic.sale_lines(window)
    return Fact(lines, BY_OPTOMETRIST, metrics, entity="PATIENTID" if distinct else None)


def _visit_fact(clinic: Clinic, window: DateRange) -> Fact:
    return Fact(clinic.within("appointment", "STARTDATE", window), {"staff": "RESID"}, VISITS)


def _exam_fact(clinic: Clinic, window: DateRange) -> Fact:
    return Fact(clinic.within("examination", "EXAM_DATE", window), BY_OPTOMETRIST, EXAMS, entity="PATIENT_ID")


def _letter_fact(clinic: Clinic, window: DateRange) -> Fact:
    return Fact(clinic.within("patient_letters", "DATE_ADDED", window), {"staff": "USER_ADDED"}, LETTERS)


def optom_appointments(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_visit_fact(clinic, window)])


def optom_exams(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_exam_fact(clinic, window)])


def optom_revenue(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_optometrist_lines(clinic, window, REVENUE)])


def optom_item_billing(
    clinic: Clinic, window: DateRange, items: dict[str, tuple[str, ...]] = BILLED_ITEMS
) -> DataFrame:
    return tally([_optometrist_lines(clinic, window, billing_metrics(items))])


def optom_letters(clinic: Clinic, window: DateRange) -> DataFrame:
    return tally([_letter_fact(clinic, window)])


def optometrist_scorecard(
    clinic: Clinic,
    windows: Windows,
    excluded: Sequence[str] = ("",),
    items: dict[str, tuple[str, ...]] = BILLED_ITEMS,
) -> DataFrame:
    """18 metrics per active optometrist over all branches; people without activity stay, with zeros."""
    clock = _clock_fact(clinic, window_for(windows, "clockinout"), {"staff": "USER_ADDED"}, [CLOCK])
    scores = tally(
        [
            _optometrist_lines(clinic, window_for(windows, "invoice"), [*REVENUE, *billing_metrics(items)]),
            _visit_fact(clinic, window_for(windows, "appointment")),
            _exam_fact(clinic, window_for(windows, "examination")),
            clock,
            _letter_fact(clinic, window_for(windows, "patient_letters")),
        ],
        active_optometrists(clinic, excluded),
    )
    return scores.select(F.col("staff").alias("optometrist"), *OPTOMETRIST_COLUMNS)
