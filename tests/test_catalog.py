from datetime import date

import duckdb
import pytest

from lensmill.functions.windows import DateRange
from lensmill.plans import branch, staff, suite
from lensmill.plans.labels import write_suite
from checks import adapter
from lensmill.sources.catalog import (
    SCHEMAS,
    SPLIT_COLUMNS,
    check_schema,
    jdbc_options,
    load_parquet,
    quantile_bounds,
    range_predicates,
    split_by,
)
from lensmill.sources.layout import write_monthly
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
QUARTER = DateRange(date(1998, 9, 15), date(1998, 11, 14))


def test_schema_is_checked(spark):
    with pytest.raises(ValueError, match="TIMESTMP: expected timestamp_ntz, got nothing"):
        check_schema("clockinout", spark.sql("select 'x' as BRANCH_IDENTIFIER, 'y' as USER_ADDED"))
    with pytest.raises(ValueError, match="USER_TYPE: expected int, got string"):
        check_schema("users", spark.sql("select 'x' IDENTIFIER, '1' USER_TYPE, 0 INACTIVE, '' GIVEN_NAME, '' SURNAME"))


def test_jdbc_scan_is_split_by_key():
    split = jdbc_options("jdbc:x", "dbo.INVOICE", "ID", 1, 900, 8)
    assert split["partitionColumn"] == "ID" and split["numPartitions"] == "8" and split["upperBound"] == "900"
    assert "partitionColumn" not in jdbc_options("jdbc:x", "dbo.USERS", None, 0, 0, 8)


@pytest.mark.parametrize("name", SCHEMAS)
def test_every_table_is_split_by_a_column_it_has(name):
    columns = {part.split()[0]: part.split()[1] for part in SCHEMAS[name].replace(", ", ",").split(",") if " " in part}
    if name in SPLIT_COLUMNS:
        key, low, high = split_by(name, {name: (1, 900)})
        assert columns[key] in ("bigint", "timestamp_ntz") and (low, high) == (1, 900)
        assert jdbc_options("jdbc:x", name, key, low, high)["partitionColumn"] == key
    else:
        with pytest.raises(ValueError, match="can't be split"):
            split_by(name, {name: (1, 900)})
    assert split_by(name, {}) == (None, 0, 0)


def test_split_column_can_be_chosen():
    assert split_by("invoice", {"invoice": ("SALE_DATE", "2020-01-01", "2020-02-01")})[0] == "SALE_DATE"
    with pytest.raises(ValueError, match="invoice_items can't be split by ID"):
        split_by("invoice_items", {"invoice_items": ("ID", 1, 2)})


def test_sale_lines_are_stored_once_per_suite(spark, branches, tmp_path):
    clinic = adapter.load(spark, SF)
    kept = suite.with_stored_lines(clinic, QUARTER, str(tmp_path / "lines"))
    assert rows(branch.branch_masterdata(kept, QUARTER, branches)) == rows(branch.branch_masterdata(clinic, QUARTER, branches))
    assert all("lines" in f for f in kept.sale_lines(QUARTER).inputFiles())
    assert kept.sale_lines(DateRange(date(1998, 1, 1), date(1998, 1, 31))).count() > 0


@pytest.fixture(scope="module")
def monthly(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("monthly"))
    write_monthly(adapter.load(spark, SF), root)
    return load_parquet(spark, root)


def test_monthly_layout_gives_the_same_reports(spark, monthly, branches):
    views = adapter.load(spark, SF)
    assert set(SCHEMAS) == {name for name in SCHEMAS if monthly[name].count() == views[name].count()}
    for build in (
        lambda c: branch.branch_masterdata(c, QUARTER, branches),
        lambda c: staff.dispenser_scorecard(c, QUARTER, branches),
        lambda c: branch.unique_customers_fy(c, QUARTER, branches),
    ):
        assert rows(build(monthly)) == rows(build(views))


def test_monthly_layout_reads_only_the_months_asked_for(monthly):
    lines = monthly.sale_lines(QUARTER)
    files = lines.inputFiles()
    months = {part.split("SALE_DATE_MONTH=")[1][:7] for part in files}
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "1995-01" in months  # the tables hold more
    assert plan.count("PartitionFilters: [isnotnull(SALE_DATE_MONTH") == 2


def test_suites(spark, branches, tmp_path):
    clinic = adapter.load(spark, SF)
    assert list(suite.monthly_suite(clinic, date(1998, 11, 15), branches)) == [
        "utilisation", "unique_customers_fy", "trial_followup", "branch_masterdata", "dispenser_scorecard", "optometrist_scorecard",
    ]
    weekly = suite.weekly_suite(clinic, date(1998, 11, 15), branches)
    assert list(weekly) == ["unique_customers_fy", "utilisation", "branch_masterdata"]
    paths = write_suite(weekly, str(tmp_path), DateRange(date(1998, 11, 9), date(1998, 11, 15)), weekly=True)
    assert paths["branch_masterdata"].endswith("report-masterdata-1998-11-09-to-1998-11-15.csv")
    assert spark.read.csv(paths["unique_customers_fy"], header=True).columns == ["Branch", "Unique Cx FY98"]
    written = spark.read.csv(paths["branch_masterdata"], header=True)
    assert written.columns[:4] == ["branch", "appt_px_all", "Gls Appt No", "Cl Appt No"] and written.count() == 2
    scores = {"dispenser_scorecard": staff.dispenser_scorecard(clinic, QUARTER, branches)}
    path = write_suite(scores, str(tmp_path), QUARTER)["dispenser_scorecard"]
    assert spark.read.csv(f"{path}/branch=B0", header=True).columns[:3] == ["Dispenser Code", "#cust", "#sale"]


def test_ranges_of_a_skewed_key_hold_even_shares():
    """Nine tenths of the rows lie in a hundredth of the keys."""
    histogram = [(k, 900 if k < 10 else 1) for k in range(0, 1000)]
    bounds = quantile_bounds(histogram, 8)
    predicates = range_predicates("ID", bounds)
    con = duckdb.connect()
    con.execute("create table t as select unnest(range(0, 1000)) as ID union all select null")
    con.execute("create table n as select ID, case when ID < 10 then 900 when ID is null then 5 else 1 end as n from t")
    shares = [con.execute(f"select coalesce(sum(n), 0) from n where {p}").fetchone()[0] for p in predicates]
    total = 9000 + 990 + 5
    assert sum(shares) == total and len(shares) <= 8 and max(shares) <= total / 8 + 900
    # Every row is in exactly one range.
    one = " + ".join(f"(case when {p} then 1 else 0 end)" for p in predicates)
    assert con.execute(f"select count(*) from t where {one} <> 1").fetchone()[0] == 0


def test_ranges_of_odd_histograms():
    assert range_predicates("ID", quantile_bounds([], 8)) == ["1 = 1"]
    assert range_predicates("ID", quantile_bounds([(5, 100)], 8)) == ["1 = 1"]
    days = quantile_bounds([("2020-01-02", 1), ("2020-01-01", 1)], 2)
    assert range_predicates("TIMESTMP", days) == ["TIMESTMP < '2020-01-02' or TIMESTMP is null", "TIMESTMP >= '2020-01-02'"]
