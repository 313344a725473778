"""Every report and job as a query over the test tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks import adapter, inputs as I
from lensmill.functions.windows import DateRange, fiscal_year_start
from lensmill.plans import audience, branch, capacity, claims, cube, enquiry, first_purchase, labels, maintenance, staff, suite
from lensmill.session import tune
from lensmill.sources import sinks
from lensmill.sources.catalog import Clinic, load_parquet
from lensmill.sources.layout import write_monthly
from lensmill.sources.text import folder_name, raw_lines, read_template_table
from lensmill.streaming.landing import benefit_landing, read_landed

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """The tables and dimensions of one run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir
        self.clinic: Clinic = adapter.load(spark, sf_dir)

    def derive(self, text: str) -> DataFrame:
        return I.derive(self.spark, self.sf_dir, text)

    @property
    def branches(self) -> DataFrame:
        return self.derive(I.BRANCHES)

    @property
    def appt_budget(self) -> DataFrame:
        return self.derive(I.APPT_BUDGET)

    @property
    def appointment_info(self) -> DataFrame:
        return self.derive(I.APPOINTMENT_INFO)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share. It is left to the owner of that folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/shared"
    return f"{root}/{label}-{uuid.uuid4().hex}"


def _suite_rows(reports: dict[str, DataFrame]) -> DataFrame:
    """Every value of a suite as (report, row, metric, value); a report without measures has one row per key."""

    def values(name: str, frame: DataFrame) -> DataFrame:
        keys = I.SUITE_KEYS[name]
        key = F.concat_ws("|", *keys).alias("row")
        measures = [c for c in frame.columns if c not in keys]
        of = [(c, F.col(c)) for c in measures] or [("rows", F.lit(1))]
        long = F.array(*(F.struct(F.lit(c).alias("metric"), v.cast("decimal(38,4)").alias("value")) for c, v in of))
        return frame.select(F.lit(name).alias("report"), key, F.inline(long))

    return reduce(DataFrame.unionAll, (values(name, frame) for name, frame in reports.items()))


def _with_stored_lines(x: Inputs, windows: dict) -> Clinic:
    return suite.with_stored_lines(x.clinic, windows["default"], shared_path(x.spark, "sale-lines"))


#: Tables that a job keeps up to date, and reports read: written once per session and data.
_KEPT: dict[tuple, object] = {}


def _kept(x: Inputs, name: str, *of: object, write: Callable[[], object]) -> object:
    key = (x.spark.sparkContext.applicationId, x.sf_dir, name, *of)
    if key not in _KEPT:
        _KEPT[key] = write()
    return _KEPT[key]


def _cube(x: Inputs, windows: dict) -> tuple[cube.Cube, first_purchase.Index]:
    return _kept(x, "cube", repr(windows), write=lambda: _written_cube(x, windows))


def _written_cube(x: Inputs, windows: dict) -> tuple[cube.Cube, first_purchase.Index]:
    """Day partials and the first-purchase index of the windows' days. The fiscal year's older days come in later ones'
    wake, and the window's first days twice."""
    stored = cube.Cube(x.spark, x.clinic, shared_path(x.spark, "cube"))
    orders, events = windows["default"], windows["appointment"]
    by_events = ("visits", "clock", "exams", "letters")
    stored.update(orders, [n for n in cube.sources(x.clinic, orders) if n not in by_events])
    stored.update(events, by_events)
    stored.update(DateRange(orders.first, orders.first + timedelta(days=1)), ("lines", "invoices"))
    index = first_purchase.Index(x.spark, x.clinic, shared_path(x.spark, "first-purchase"))
    index.update(orders)
    index.update(DateRange(fiscal_year_start(orders.first), orders.first - timedelta(days=1)))
    index.update(orders)
    return stored, index


def _monthly(x: Inputs) -> Clinic:
    """The library's own layout and joins, over a copy of the test tables."""

    def write() -> str:
        root = shared_path(x.spark, "monthly")
        write_monthly(x.clinic, root)
        return root

    return load_parquet(x.spark, _kept(x, "monthly", write=write))


def _report_csv(x: Inputs) -> DataFrame:
    report = branch.branch_masterdata(x.clinic, I.MONTH_WINDOWS, x.branches)
    path = sinks.write_report(report, shared_path(x.spark, "csv"), "masterdata", I.MONTH)
    return x.spark.read.schema(report.schema).csv(path, header=True)


def _suite_files(x: Inputs) -> DataFrame:
    """The monthly suite as the files users open, read again by their printed headings: (title, row, heading, value)."""
    reports = suite.monthly_suite(x.clinic, I.ORDERS_AS_OF, x.branches, I.MONTH_WINDOWS)
    paths = labels.write_suite({n: reports[n] for n in I.SUITE_FILES}, shared_path(x.spark, "suite"), I.MONTH)

    def values(name: str) -> DataFrame:
        table = x.spark.read.csv(paths[name], header=True)
        key, *headings = table.columns
        long = F.array(*(F.struct(F.lit(h).alias("heading"), F.col(f"`{h}`").cast("decimal(38,4)").alias("value")) for h in headings))
        return table.select(F.lit(labels.TITLES[name]).alias("title"), F.col(f"`{key}`").alias("row"), F.inline(long))

    return reduce(DataFrame.unionAll, map(values, I.SUITE_FILES))


def _claim_batches_joined(x: Inputs) -> DataFrame:
    """Batches written end to end and read again: (file, record, n)."""
    path = shared_path(x.spark, "batches")
    sinks.write_claim_batches(claims.claims_reordered(x.derive(I.CLAIM_LINES)), path, joined=True)
    whole = raw_lines(x.spark.read.text(f"{path}/*", wholetext=True), folder_name())
    each = whole.select("file", F.explode(F.regexp_extract_all("line", F.lit(claims.CLAIM_RECORD), F.lit(0))).alias("record"))
    return each.groupBy("file", "record").agg(F.count("*").alias("n"))


def _dispenser_csv_by_branch(x: Inputs) -> DataFrame:
    report = staff.dispenser_scorecard(x.clinic, I.MONTH_WINDOWS, x.branches)
    path = sinks.write_report_by_branch(report, shared_path(x.spark, "csv"), "dispensers", I.MONTH)
    return x.spark.read.schema(report.schema).csv(path, header=True).select(report.columns)


def _claim_batches_written(x: Inputs) -> DataFrame:
    """Batches written and read again: (file, place, record), the place counted over the files of a batch."""
    path = shared_path(x.spark, "batches")
    sinks.write_claim_batches(claims.claims_reordered(x.derive(I.CLAIM_LINES)), path)
    lines = raw_lines(x.spark.read.text(f"{path}/*"), folder_name()).withColumn("_id", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("file").orderBy("path", "_id"))
    return lines.select("file", place.cast("bigint").alias("place"), F.col("line").alias("record"))


def _landing(x: Inputs) -> DataFrame:
    """Writes the derived report files to the shared folder, picks them up twice and returns the summary."""
    root = shared_path(x.spark, "landing")
    # One part file per report: Spark names files itself, so the report's name is that of its folder.
    lines = x.derive(I.REPORT_LINES).repartition("file").sortWithinPartitions("file", "line_no")
    lines.selectExpr("file as report", "line as value").write.partitionBy("report").text(f"{root}/incoming")
    for _ in range(2):
        for query in benefit_landing(
            x.spark,
            f"{root}/incoming/*",
            f"{root}/target",
            f"{root}/progress",
            x.branches,
            x.clinic["patient"],
            name=folder_name(),
        ):
            query.awaitTermination()
    return read_landed(x.spark, f"{root}/target", "summary")


def _templates(x: Inputs) -> DataFrame:
    """Templates written as files, one folder each, and read again as a table."""
    path = shared_path(x.spark, "templates")
    of = x.spark.createDataFrame(list(I.TEMPLATES.items()), "type string, value string")
    of.write.partitionBy("type").option("lineSep", "\u0003").text(path)
    read = read_template_table(x.spark, f"{path}/*", folder_name())
    return read.select("type", F.rtrim("template", F.lit("\u0003")).alias("template"))


def _messages_by_type(x: Inputs) -> DataFrame:
    people = audience.audience_pre_exam(x.clinic, I.EVENTS_AS_OF, I.EVENTS_AS_OF).withColumn("TYPE", F.expr(I.TYPE))
    return audience.render_by_type(people, _templates(x), x.branches, x.appointment_info).select("ID", "EMAIL", "message")


def _cleared_table(x: Inputs) -> tuple[str, str, dict[str, int]]:
    """The stored category rows after their stale marks were deleted in place, twice."""

    def clear() -> tuple[str, str, dict[str, int]]:
        root, work = (shared_path(x.spark, n) for n in ("categories", "eligibility"))
        maintenance.write_categories(x.clinic["patient_categories_link"], root)
        counts = maintenance.clear_eligibility(x.spark, x.clinic, I.EVENTS_AS_OF, root, work)
        maintenance.clear_eligibility(x.spark, x.clinic, I.EVENTS_AS_OF, root, shared_path(x.spark, "eligibility"))
        return root, work, counts

    return _kept(x, "eligibility", write=clear)


ONE_DAY = date(1998, 10, 12)

REPORTS: dict[str, Callable[[Inputs], DataFrame]] = {
    # per branch
    "trial_followup": lambda x: branch.trial_followup(x.clinic, I.MONTH),
    "cl_orders_vs_exams": lambda x: branch.cl_orders_vs_exams(x.clinic, I.MONTH_WINDOWS, x.branches),
    "glasses_customers_vs_exams": lambda x: branch.glasses_customers_vs_exams(x.clinic, I.MONTH_WINDOWS, x.branches),
    "unique_customers_fy": lambda x: branch.unique_customers_fy(x.clinic, I.MONTH, x.branches),
    "unique_customers_fy_weekly": lambda x: branch.unique_customers_fy(x.clinic, I.WEEK, x.branches),
    "utilisation": lambda x: branch.utilisation(x.clinic, I.MONTH, x.branches),
    "utilisation_weekly": lambda x: branch.utilisation(x.clinic, I.WEEK, x.branches),
    "utilisation_all_dates": lambda x: branch.utilisation(x.clinic, I.ALL_ORDER_DATES, x.branches),
    "branch_masterdata": lambda x: branch.branch_masterdata(x.clinic, I.MONTH_WINDOWS, x.branches),
    "branch_masterdata_weekly": lambda x: branch.branch_masterdata(x.clinic, I.WEEK_WINDOWS, x.branches),
    "branch_masterdata_all_dates": lambda x: branch.branch_masterdata(x.clinic, I.ALL_WINDOWS, x.branches),
    # per staff member
    "dispenser_scorecard": lambda x: staff.dispenser_scorecard(x.clinic, I.MONTH_WINDOWS, x.branches),
    "dispenser_scorecard_all_dates": lambda x: staff.dispenser_scorecard(x.clinic, I.ALL_WINDOWS, x.branches),
    "optometrist_scorecard": lambda x: staff.optometrist_scorecard(x.clinic, I.MONTH_WINDOWS),
    "optometrist_scorecard_all_dates": lambda x: staff.optometrist_scorecard(x.clinic, I.ALL_WINDOWS),
    "staff_sales": lambda x: staff.staff_sales(x.clinic, I.MONTH),
    "staff_net_counts": lambda x: staff.staff_net_counts(x.clinic, I.MONTH),
    "staff_discounts": lambda x: staff.staff_discounts(x.clinic, I.MONTH),
    "staff_order_stages": lambda x: staff.staff_order_stages(x.clinic, I.MONTH),
    "staff_warranty_cancel": lambda x: staff.staff_warranty_cancel(x.clinic, I.MONTH),
    "staff_clock_days": lambda x: staff.staff_clock_days(x.clinic, I.EVENT_WEEK),
    "staff_priced": lambda x: staff.staff_priced(x.clinic, I.MONTH),
    "optom_appointments": lambda x: staff.optom_appointments(x.clinic, I.EVENT_WEEK),
    "optom_exams": lambda x: staff.optom_exams(x.clinic, I.EVENT_WEEK),
    "optom_revenue": lambda x: staff.optom_revenue(x.clinic, I.MONTH),
    "optom_item_billing": lambda x: staff.optom_item_billing(x.clinic, I.MONTH),
    "optom_letters": lambda x: staff.optom_letters(x.clinic, I.EVENT_WEEK),
    "active_dispensers": lambda x: staff.active_dispensers(x.clinic, ("D3",)),
    "active_optometrists": lambda x: staff.active_optometrists(x.clinic, ("", "O5")),
    # capacity
    "daily_volume": lambda x: capacity.daily_volume(x.clinic, I.EVENTS_AS_OF, x.branches),
    "daily_fte": lambda x: capacity.daily_fte(x.clinic, I.EVENTS_AS_OF, x.branches),
    "daily_fte_vs_budget": lambda x: capacity.daily_fte_vs_budget(x.clinic, I.EVENTS_AS_OF, x.branches),
    "daily_optometrists": lambda x: capacity.daily_optometrists(x.clinic, I.EVENTS_AS_OF, x.branches),
    "daily_fte_actual": lambda x: capacity.daily_fte_actual(x.clinic, I.EVENTS_AS_OF, x.branches),
    "daily_volume_vs_budget": lambda x: capacity.daily_volume_vs_budget(
        x.clinic, I.EVENTS_AS_OF, x.branches, x.appt_budget
    ),
    "capacity_report": lambda x: capacity.capacity_report(x.clinic, I.EVENTS_AS_OF, x.branches, x.appt_budget),
    # mail
    "audience_feedback": lambda x: audience.audience_feedback(x.clinic, I.EVENTS_AS_OF, I.EVENTS_AS_OF, I.MONTH),
    "audience_followup": lambda x: audience.audience_followup(x.clinic, ONE_DAY, I.ORDERS_AS_OF),
    "audience_pre_exam": lambda x: audience.audience_pre_exam(x.clinic, I.EVENTS_AS_OF, I.EVENTS_AS_OF),
    "audience_script_expiry": lambda x: audience.audience_script_expiry(x.clinic, I.ORDERS_AS_OF),
    "render_messages": lambda x: audience.render_messages(
        audience.audience_pre_exam(x.clinic, I.EVENTS_AS_OF, I.EVENTS_AS_OF),
        I.TEMPLATE,
        x.branches,
        x.appointment_info,
    ).select("ID", "EMAIL", "message"),
    # files
    "claims_reordered": lambda x: claims.claims_reordered(x.derive(I.CLAIM_LINES)),
    "benefit_files": lambda x: claims.benefit_files(x.derive(I.REPORT_NAMES), x.branches),
    "files_for_branch": lambda x: claims.files_for_branch(x.derive(I.CODED_NAMES), x.derive(I.CODED_BRANCHES)),
    "benefit_summary": lambda x: claims.benefit_summary(x.derive(I.REPORT_LINES), x.branches, x.clinic["patient"]),
    "benefit_summary_by_branch": lambda x: claims.benefit_summary_by_branch(
        x.derive(I.REPORT_LINES), x.branches, x.clinic["patient"], "B2"
    ),
    "enquiry_records": lambda x: enquiry.enquiry_records(x.derive(I.RESPONSES)),
    "enquiry_dep": lambda x: enquiry.records(x.derive(I.RESPONSES), "dep"),
    "enquiry_gaps": lambda x: enquiry.records(x.derive(I.RESPONSES), "gaps"),
    "enquiry_histc": lambda x: enquiry.records(x.derive(I.RESPONSES), "histc"),
    "enquiry_details": lambda x: enquiry.records(x.derive(I.RESPONSES), "details"),
    "search_keys": lambda x: enquiry.search_keys(x.clinic["patient"]),
    "request_keys": lambda x: enquiry.request_keys(x.clinic["patient"], "MEMBER_NUMBER"),
    "response_diff": lambda x: enquiry.response_diff(x.derive(I.RESPONSES)),
    "response_diff_aligned": lambda x: enquiry.response_diff(x.derive(I.RESPONSES), aligned=True),
    "response_alignment": lambda x: enquiry.response_alignment(x.derive(I.REORDERED)),
    "benefit_landing": _landing,
    # sinks, and the library's own layout
    "report_csv": _report_csv,
    "dispenser_csv_by_branch": _dispenser_csv_by_branch,
    "claim_batches_written": _claim_batches_written,
    "claim_batches_joined": _claim_batches_joined,
    "suite_files": _suite_files,
    "branch_masterdata_monthly_layout": lambda x: branch.branch_masterdata(_monthly(x), I.MONTH_WINDOWS, x.branches),
    "dispenser_scorecard_monthly_layout": lambda x: staff.dispenser_scorecard(_monthly(x), I.MONTH_WINDOWS, x.branches),
    # day partials: the same reports, re-folded
    "branch_masterdata_from_days": lambda x: _cube(x, I.MONTH_WINDOWS)[0].branch_masterdata(I.WEEK_WINDOWS | {"default": I.LAST_WEEK}, x.branches),
    "dispenser_scorecard_from_days": lambda x: _cube(x, I.MONTH_WINDOWS)[0].dispenser_scorecard(I.MONTH_WINDOWS, x.branches),
    "optometrist_scorecard_from_days": lambda x: _cube(x, I.MONTH_WINDOWS)[0].optometrist_scorecard(I.MONTH_WINDOWS),
    "unique_customers_fy_from_index": lambda x: _cube(x, I.MONTH_WINDOWS)[1].unique_customers(I.MONTH, x.branches),
    "report_suite_monthly_from_days": lambda x: _suite_rows(
        cube.monthly_suite(*_cube(x, I.MONTH_WINDOWS), I.ORDERS_AS_OF, x.branches, I.MONTH_WINDOWS)
    ),
    "report_suite_weekly_from_days": lambda x: _suite_rows(
        cube.weekly_suite(*_cube(x, I.WEEK_WINDOWS), I.ORDERS_AS_OF, x.branches, I.WEEK_WINDOWS)
    ),
    # maintenance and suites
    "eligibility_cleared": lambda x: maintenance.eligibility_cleared(x.clinic, I.EVENTS_AS_OF),
    "eligibility_cleared_count": lambda x: maintenance.eligibility_cleared_count(x.clinic, I.EVENTS_AS_OF),
    "eligibility_kept": lambda x: maintenance.eligibility_kept(x.clinic, I.EVENTS_AS_OF),
    "eligibility_table_kept": lambda x: maintenance.read_categories(x.spark, _cleared_table(x)[0]),
    "eligibility_table_cleared": lambda x: x.spark.read.parquet(f"{_cleared_table(x)[1]}/cleared").drop("part"),
    "eligibility_table_count": lambda x: x.spark.createDataFrame([(_cleared_table(x)[2]["cleared"],)], "cleared long"),
    "messages_by_type": _messages_by_type,
    "report_suite_monthly": lambda x: _suite_rows(
        suite.monthly_suite(_with_stored_lines(x, I.MONTH_WINDOWS), I.ORDERS_AS_OF, x.branches, I.MONTH_WINDOWS)
    ),
    "report_suite_weekly": lambda x: _suite_rows(
        suite.weekly_suite(_with_stored_lines(x, I.WEEK_WINDOWS), I.ORDERS_AS_OF, x.branches, I.WEEK_WINDOWS)
    ),
}


def queries() -> dict[str, Query]:
    def bind(build: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: bind(build) for name, build in REPORTS.items()}
