"""File titles and column labels of the written reports (fixed values)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lensmill.functions.windows import DateRange, fiscal_year_start
from lensmill.sources.sinks import write_report, write_report_by_branch

TITLES: dict[str, str] = {
    "trial_followup": "trialsrep",
    "cl_orders_vs_exams": "weekly_clcx_rx_vs_clex",
    "glasses_customers_vs_exams": "weeklyce",
    "unique_customers_fy": "monthly_unique_cx",
    "utilisation": "weekly_utilisation",
    "branch_masterdata": "masterdata",
    "dispenser_scorecard": "dispensers",
    "optometrist_scorecard": "optometrists",
}

LABELS: dict[str, dict[str, str]] = {
    "cl_orders_vs_exams": {"branch": "Branch", "cl_cx": "Cl Cx", "cl_ex": "Cl Exams"},
    "glasses_customers_vs_exams": {"branch": "Branch", "gl_cx": "Glasses Cx", "gl_ex": "Glasses/Lenses Exams"},
    "utilisation": {"branch": "Branch", "utilisation": "Utilisation Cx"},
    "branch_masterdata": {
        "gls_appt_no": "Gls Appt No",
        "cl_appt_no": "Cl Appt No",
        "gl_cx_no": "Gl Cx No",
        "cl_cx_no": "Cl Cx No",
        "cl_cx_per_rx": "CL Cx Per RX",
        "total_appt_no": "Total Appt No",
        "oct_no": "OCT No",
        "cl_new_fit": "CL New Fit",
        "cl_refit": "Cl Refit",
        "unique_cx": "Unique Cx Per Month",
    },
    "dispenser_scorecard": {
        "dispenser": "Dispenser Code",
        "cust": "#cust",
        "sale": "#sale",
        "fr_qty": "#fr",
        "fr_amt": "$fr",
        "lens_qty": "#lens",
        "lens_amt": "$lens",
        "suns_qty": "#suns",
        "suns_amt": "$suns",
        "own_fr": "#own_fr",
        "own_fr_cx": "#own_fr_cx",
        "lens_ng": "#lens_ng",
        "mgmt_d": "$mgmt_d",
        "match_d": "$match_d",
        "total_d": "$total_d",
        "unpaid": "$unpaid",
        "remake": "#r/make",
        "w_days": "#w_days",
        "wrty": "#wrty",
        "cncl": "#cncl",
        "px_2pr": "#px_2pr",
        "fit": "#fit",
        "check": "#check",
        "pack": "#pack",
        "deliv": "#deliv",
        "priced": "#priced",
    },
    "optometrist_scorecard": {
        "optometrist": "Optom Code",
        "cl_cx": "#cl_cx",
        "cl_amt": "$cl",
        "cl_appt": "#cl_appt",
        "lt_appt": "#lt_appt",
        "lens_qty": "#lens",
        "lens_amt": "$lens",
        "upx": "#upx",
        "ex": "#ex",
        "cons_amt": "$cons",
        "w_days": "#w_days",
        "item_910_11": "#910/11",
        "item_912_14": "#912/13/14",
        "item_916_18": "#916/18",
        "item_940_41": "#940/41",
        "tmpl": "#tmpl",
        "amd": "#amd",
        "cat": "#cat",
        "lasik": "#lasik",
    },
}


def labelled(name: str, report: DataFrame, fiscal_year: int | None = None, weekly: bool = False) -> DataFrame:
    """The report with its printed column labels; first-time customers carry the fiscal year, and are yearly ones only
    in the monthly report."""
    labels = LABELS.get(name, {})
    if name == "unique_customers_fy" and fiscal_year:
        labels = {"branch": "Branch", "unique_cx": f"Unique {'' if weekly else 'Yearly '}Cx FY{fiscal_year % 100:02d}"}
    return report.withColumnsRenamed(labels)


def write_suite(reports: dict[str, DataFrame], root: str, window: DateRange, weekly: bool = False) -> dict[str, str]:
    """Writes every report of a suite as CSV, by branch or staff code, and returns the paths.

    Dispensers go to one folder per branch. The fiscal year is named after the year it starts in.
    """
    year = fiscal_year_start(window.first).year
    paths = {}
    for name, report in reports.items():
        if name == "dispenser_scorecard":
            ordered, write = report.orderBy("branch", "dispenser"), write_report_by_branch
        else:
            # Trials come sorted; the other reports start with their key.
            ordered = report if name == "trial_followup" else report.orderBy(report.columns[0])
            write = write_report
        paths[name] = write(labelled(name, ordered, year, weekly), root, TITLES[name], window)
    return paths
