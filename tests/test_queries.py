"""Every registered query against its SQL, and rules every plan keeps."""

import pytest

import __spark_entry__ as contract
from checks import adapter, inputs, registry
from checks.compare import connect, rows_match
from lensmill.plans import staff
from lensmill.sources.catalog import load_parquet
from lensmill.sources.layout import write_monthly

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_contract(spark):
    assert contract.entry(spark).count() == 7
    assert set(registry.REPORTS) <= set(contract.oracle_sql()) & set(contract.queries())


@pytest.mark.parametrize("name", registry.REPORTS)
def test_query_equals_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF)
    got = [tuple(r) for r in frame.collect()]
    assert rows_match(frame.columns, got, duck, contract.oracle_sql()[name]) == ""


# These write files before they return; their reports are checked under other names.
WRITING = {"benefit_landing", "report_csv", "dispenser_csv_by_branch", "claim_batches_written", "claim_batches_joined", "suite_files"} | {
    n for n in registry.REPORTS if n.startswith("report_suite") or n.endswith("_layout")
}


@pytest.mark.parametrize("name", [n for n in registry.REPORTS if n not in WRITING])
def test_plan_scales(spark, name):
    """No pair-wise join, no Python worker, no broadcast hint, and hash aggregation throughout.

    The one exception picks a name per member; its sort serves the merge join that follows.
    """
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "hint", "SortAggregate", "ObjectHashAggregate"):
        if not (node == "SortAggregate" and name.startswith("benefit_summary")):
            assert node not in plan, f"{node} in {name}"


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("branch_masterdata", "GreaterThanOrEqual(o_orderdate,1998-10-01T00:00)"),
        ("dispenser_scorecard", "LessThanOrEqual(o_orderdate,1998-10-31T23:59:59)"),
        ("daily_volume", "GreaterThanOrEqual(ts,2024-01-08T00:00)"),
        ("unique_customers_fy", "GreaterThanOrEqual(o_orderdate,1998-07-01T00:00)"),
    ],
)
def test_window_reaches_the_scan(spark, name, pushed):
    frame = contract.queries()[name](spark, SF)
    plan = frame._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert any(pushed in line for line in plan.splitlines() if "PushedFilters" in line)


def test_claims_are_parsed_once(spark):
    """The record pattern feeds one exchange that the plan uses twice."""
    frame = contract.queries()["claims_reordered"](spark, SF)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 1 and final.count("regexp_extract_all") == 1


def test_one_branch_reads_only_its_lines(spark):
    """The provider is a literal on the file name, before any pattern runs on the lines."""
    plan = contract.queries()["benefit_summary_by_branch"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "A100002" in plan and "LeftSemi" not in plan


def test_predicates_reach_the_items(spark, tmp_path):
    """In the library's own layout, an item report's barcodes are pushed to the scan of the items, before the join."""
    write_monthly(adapter.load(spark, SF), str(tmp_path))
    frame = staff.optom_item_billing(load_parquet(spark, str(tmp_path)), inputs.MONTH)
    plan = frame._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert any("ITEM_BARCODE" in line for line in plan.splitlines() if "PushedFilters" in line)


def test_results_hold_without_broadcasts(spark, duck):
    """The plans a large cluster would use: sort-merge joins throughout."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        for name in ("branch_masterdata", "dispenser_scorecard", "audience_feedback", "benefit_summary", "claims_reordered"):
            frame = contract.queries()[name](spark, SF)
            got = [tuple(r) for r in frame.collect()]
            assert rows_match(frame.columns, got, duck, contract.oracle_sql()[name]) == "", name
    finally:
        for key in keys:
            spark.conf.unset(key)
