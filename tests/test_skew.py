"""Hot keys: one invoice, patient or member with a third of all rows."""

import pytest
from pyspark.sql import functions as F

from lensmill.functions.windows import DateRange
from lensmill.plans import staff
from lensmill.session import RUNTIME, tune
from lensmill.sources.catalog import Clinic
from tests.conftest import day

MAY = DateRange(day("2020-05-01"), day("2020-05-31"))
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_partitions(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


def hot_clinic(spark) -> Clinic:
    """200,000 items of 20,000 invoices; invoice 7 and its patient hold a third of them."""
    invoice = spark.range(20_000, numPartitions=8).selectExpr(
        "id as ID", "if(id % 3 = 0, 1, id) as PATIENTID", "timestamp_ntz'2020-05-10 00:00:00' as SALE_DATE",
        "'B0' as BRANCH_IDENTIFIER", "'D' || id % 3 as USER_ADDED", "2 as TYPE", "cast(5 as decimal(18,2)) as DESPENSE_TOTAL",
        "cast(null as int) as DISCOUNTID", "cast(3 as decimal(18,2)) as STOCK_CHARGED", "cast(1 as decimal(18,2)) as STOCK_PAID",
    )
    items = spark.range(200_000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 7, id % 20000) as INVOICEID", "cast(1 as int) as QTY", "cast(2 as decimal(18,2)) as UNITPRICE",
        "cast(1 as decimal(18,4)) as DISCOUNT_AMOUNT", "cast(2 + id % 2 as int) as STOCK_TYPE", "'X' || id as ITEM_BARCODE",
    )
    return Clinic({"invoice": invoice, "invoice_items": items})


def test_hot_invoice_is_split_and_counts_stay_whole(spark, small_partitions):
    clinic = hot_clinic(spark)
    scores = staff.staff_net_counts(clinic, MAY)
    got = {r.staff: r for r in scores.collect()}
    lines = clinic["invoice"].join(clinic["invoice_items"], F.col("ID") == F.col("INVOICEID"))
    expected = lines.groupBy("USER_ADDED").agg(F.countDistinct("PATIENTID").alias("cust"), F.countDistinct("ID").alias("sale"))
    for row in expected.collect():
        assert (got[row.USER_ADDED].cust, got[row.USER_ADDED].sale) == (row.cust, row.sale)
    assert "skew=true" in scores._jdf.queryExecution().executedPlan().toString()


def test_invoice_fold_reuses_the_join_partitioning(spark):
    """Items and invoices are shuffled once each; the per-invoice fold adds no exchange."""
    for key in list(SMALL)[:2]:
        spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = staff.staff_net_counts(hot_clinic(spark), MAY)._jdf.queryExecution().executedPlan().toString()
        # Two sides of the join, one fold per patient, one per staff member.
        assert plan.count("Exchange hashpartitioning") == 4
    finally:
        for key in [*list(SMALL)[:2], "spark.sql.adaptive.enabled"]:
            spark.conf.unset(key)


def test_tasks_stay_small_with_few_shuffle_partitions(spark):
    """The lines' join and fold run in as many tasks as their size asks for, whatever the session's number of partitions."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false"}
    own["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "1k"
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for name in [key, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]:
        spark.conf.unset(name)
    try:
        tune(spark)
        assert all(spark.conf.get(k) == v for k, v in RUNTIME.items())
        for name, value in (own | {key: "16k"}).items():
            spark.conf.set(name, value)
        assert tune(spark).conf.get(key) == "16k"
        lines = hot_clinic(spark).sale_lines(MAY).groupBy("ID").count()
        assert lines.rdd.getNumPartitions() > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for name in own:
            spark.conf.unset(name)
        spark.conf.set(key, RUNTIME[key])
