"""The practice tables as views over the order, line, customer and event tables of the test data.

Expressions are valid in Spark SQL and in DuckDB, so the checks use the same text.
Codes without meaning in the source (branch, staff, type) are derived by modulus.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from lensmill.functions.windows import DateRange
from lensmill.sources.catalog import Clinic

INVOICE = [
    "o_orderkey as ID",
    "o_custkey as PATIENTID",
    "o_orderdate as SALE_DATE",
    "'B' || cast(o_orderkey % 7 as string) as BRANCH_IDENTIFIER",
    "'D' || cast(o_orderkey % 11 as string) as USER_ADDED",
    "'O' || cast(o_custkey % 13 as string) as USER_IDENTIFIER",
    "case when o_orderstatus = 'P' then 6 else 2 end as TYPE",
    "cast(case when o_orderkey % 10 = 0 then 0 when o_orderstatus = 'P' then -o_totalprice else o_totalprice end"
    " as decimal(18,2)) as DESPENSE_TOTAL",
    "case when o_orderkey % 10 = 0 then 0 else 1 end as ORDER_TYPE",
    "case o_orderkey % 12 when 0 then 71 when 1 then 77 when 2 then 89 when 3 then 106 when 4 then 26"
    " when 5 then 74 when 6 then 105 when 7 then 0 else null end as DISCOUNTID",
    "cast(o_totalprice as decimal(18,2)) as STOCK_CHARGED",
    "cast(case when o_orderpriority = '5-LOW' then 0 else o_totalprice end as decimal(18,2)) as STOCK_PAID",
]

INVOICE_ITEMS = [
    "l_orderkey as INVOICEID",
    "cast(case when o_orderstatus = 'P' then -l_quantity else l_quantity end as int) as QTY",
    "cast(p_retailprice as decimal(18,2)) as UNITPRICE",
    "cast(case when o_orderstatus = 'P' then -1 else 1 end * cast(l_quantity as decimal(8,0))"
    " * cast(p_retailprice as decimal(10,2)) * cast(l_discount as decimal(4,2)) as decimal(18,4)) as DISCOUNT_AMOUNT",
    "cast(1 + l_partkey % 6 as int) as STOCK_TYPE",
    "case l_partkey % 20 when 0 then '0001' when 1 then 'GAP01' when 2 then 'NG001' when 3 then 'OCT'"
    " when 4 then 'LTPRO' when 5 then '10900' when 6 then '10912' when 7 then '10916' when 8 then '10940'"
    " else 'P' || cast(l_partkey as string) end as ITEM_BARCODE",
]

# The same item columns from an order already in invoice form and a part with its price converted.
LINE_ITEM = [
    "l_orderkey as INVOICEID",
    "cast(case when TYPE = 6 then -l_quantity else l_quantity end as int) as QTY",
    "cast(case when TYPE = 6 then -1 else 1 end * cast(l_quantity as decimal(8,0))"
    " * cast(UNITPRICE as decimal(10,2)) * cast(l_discount as decimal(4,2)) as decimal(18,4)) as DISCOUNT_AMOUNT",
    *INVOICE_ITEMS[-2:],
]

# name -> (columns, source); spectacle and lens orders together cover the whole orders table.
VIEWS: dict[str, tuple[list[str], str]] = {
    "invoice": (INVOICE, "orders"),
    "invoice_items": (
        INVOICE_ITEMS,
        "lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey",
    ),
    "patient": (
        [
            "c_custkey as ID",
            "'B' || cast(c_nationkey % 7 as string) as BRANCH_IDENTIFIER",
            "lpad(cast(c_custkey as string), 8, '0') as MEMBER_NUMBER",
            "case c_custkey % 3 when 0 then 'MR' when 1 then 'MS' else 'DR' end as TITLE",
            "'GIVEN' || cast(c_nationkey as string) as GIVEN",
            "c_name as SURNAME",
            "case when c_custkey % 8 = 0 then '' when c_custkey % 9 = 0 then null"
            " else 'p' || cast(c_custkey as string) || '@example.test' end as EMAIL",
            "c_mktsegment = 'MACHINERY' as NOEMAIL",
            "date '1940-02-29' + cast((c_custkey * 37) % 28000 as int) as BIRTHDATE",
        ],
        "customer",
    ),
    "appointment": (
        [
            "event_id as ID",
            "user_id as PATIENTID",
            "ts as STARTDATE",
            "ts + (15 + event_id % 45) * interval '1' minute as ENDDATE",
            "'B' || cast(event_id % 7 as string) as BRANCH_IDENTIFIER",
            "'O' || cast(user_id % 13 as string) as RESID",
            "case event_id % 9 when 0 then 'SC' when 1 then 'CD' when 2 then 'CL' when 3 then 'CLV' when 4 then 'LT'"
            " when 5 then 'AL' when 6 then 'LUN' when 7 then 'BRK' else 'REP' end as APPOINTMENT_TYPE",
            "case when event_type in ('error','signup') then 1 else 5 end as APP_PROGRESS",
        ],
        "events",
    ),
    "spectacle_orders": (
        [
            "o_orderkey as ID",
            "o_custkey as PATIENTID",
            "o_orderdate as ORDER_DATE",
            "case when o_orderstatus = 'O' then null else o_orderdate + interval '7' day end as COLLECTED_DATE",
            "'B' || cast(o_orderkey % 7 as string) as BRANCH_IDENTIFIER",
            "'B' || cast((o_orderkey + 3) % 7 as string) as DELIVERY_BRANCH",
            "case o_orderkey % 5 when 0 then 'P' when 1 then 'S' else '' end as WARRANTY",
            "case when o_orderkey % 17 = 0 then 1 else 0 end as CANCELLED",
            "'D' || cast(o_orderkey % 11 as string) as USER_ADDED",
            "'D' || cast(o_orderkey % 3 as string) as STAFFFIT",
            "'D' || cast(o_orderkey % 4 as string) as STAFFCHK",
            "'D' || cast(o_orderkey % 5 as string) as STAFFPCK",
            "case when o_orderkey % 6 = 0 then null else 'D' || cast(o_orderkey % 6 as string) end as STAFFDEL",
        ],
        "orders where o_orderkey % 2 = 0",
    ),
    "contact_lens_orders": (
        [
            "o_orderkey as ID",
            "o_custkey as PATIENTID",
            "o_orderdate as ORDER_DATE",
            "case when o_orderstatus = 'O' then null else o_orderdate + interval '5' day end as COLLECTED_DATE",
            "case when o_orderpriority = '1-URGENT' then o_orderdate + interval '9' day else null end"
            " as FOLLOWED_UP_DATE",
            "'B' || cast(o_orderkey % 7 as string) as BRANCH_IDENTIFIER",
            "'D' || cast(o_orderkey % 11 as string) as USER_ADDED",
            "case when o_orderkey % 17 = 0 then 1 else 0 end as CANCELLED",
            "case when o_orderkey % 4 = 1 then 1 else 0 end as TRIAL",
            "case when o_orderkey % 4 = 1 then 1 else 0 end as TRIAL_ONLY",
            "case when o_orderkey % 5 = 0 then 'P' else '' end as WARRANTY",
            "o_orderkey as RX_REFERENCE",
        ],
        "orders where o_orderkey % 2 = 1",
    ),
    "contact_rx": (
        [
            "o_orderkey as ID",
            "o_custkey as PATIENTID",
            "o_orderdate - cast(o_orderkey % 240 as int) * interval '1' day as DATE_ADDED",
            "o_orderdate + interval '365' day as EXPIRY_DATE",
        ],
        "orders where o_orderkey % 2 = 1",
    ),
    "examination": (
        [
            "event_id as ID",
            "user_id as PATIENT_ID",
            "ts as EXAM_DATE",
            "'O' || cast(user_id % 13 as string) as USER_IDENTIFIER",
        ],
        "events where event_type in ('view','purchase')",
    ),
    "clockinout": (
        [
            "ts as TIMESTMP",
            "'B' || cast(event_id % 7 as string) as BRANCH_IDENTIFIER",
            "case when event_id % 2 = 0 then 'D' || cast(event_id % 11 as string)"
            " else 'O' || cast(user_id % 13 as string) end as USER_ADDED",
        ],
        "events where event_type = 'signup'",
    ),
    "patient_letters": (
        [
            "event_id as ID",
            "ts as DATE_ADDED",
            "'O' || cast(user_id % 13 as string) as USER_ADDED",
            "case event_id % 6 when 0 then 'Treatment Plan' when 1 then 'CL Treatment Plan' when 2 then 'AMD'"
            " when 3 then 'Checklist - Cataract Referral' when 4 then 'Lasik' else 'Other' end as LETTER_DESCRIPTION",
        ],
        "events where event_type = 'click'",
    ),
    "stock_arrival": (
        [
            "l_orderkey * 10 + l_linenumber as ID",
            "l_shipdate as ARRIVAL_DATE",
            "'B' || cast(l_suppkey % 7 as string) as BRANCH_IDENTIFIER",
            "'D' || cast(l_orderkey % 11 as string) as USER_ADDED",
        ],
        "lineitem where l_returnflag = 'N'",
    ),
    "patient_categories_link": (
        ["c_custkey as PATIENT_ID", "case c_custkey % 4 when 0 then 'ME' when 1 then 'MNE' else 'VIP' end as IDENTIFIER"],
        "customer",
    ),
}

# users has two halves: dispensers from the order key, optometrists from the customer key.
DISPENSERS = [
    "'D' || cast(o_orderkey % 11 as string) as IDENTIFIER",
    "cast(2 as int) as USER_TYPE",
    "case when o_orderkey % 11 = 10 then 1 else 0 end as INACTIVE",
    "'DG' || cast(o_orderkey % 11 as string) as GIVEN_NAME",
    "'DS' as SURNAME",
]
OPTOMETRISTS = [
    "'O' || cast(o_custkey % 13 as string) as IDENTIFIER",
    "cast(1 as int) as USER_TYPE",
    "case when o_custkey % 13 = 12 then 1 else 0 end as INACTIVE",
    "'OG' || cast(o_custkey % 13 as string) as GIVEN_NAME",
    "'OS' as SURNAME",
]


# Source columns the views use; stating them saves reading file footers to plan a query.
SOURCE_SCHEMAS: dict[str, str] = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def source(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{root}/{name}.parquet")


class OrderTablesClinic(Clinic):
    """Builds sale lines with one join per source table instead of joining orders to itself."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__({name: partial(self._view, name) for name in [*VIEWS, "users"]})
        self._source = partial(source, spark, root)

    def _view(self, name: str) -> DataFrame:
        if name == "users":
            orders = self._source("orders")
            return orders.selectExpr(*DISPENSERS).distinct().unionAll(orders.selectExpr(*OPTOMETRISTS).distinct())
        columns, origin = VIEWS[name]
        if name == "invoice_items":
            sold = self._source("lineitem").join(self._source("orders"), F.col("o_orderkey") == F.col("l_orderkey"))
            return sold.join(self._source("part"), F.col("p_partkey") == F.col("l_partkey")).selectExpr(*columns)
        base, _, condition = origin.partition(" where ")
        return self._source(base).filter(condition or "true").selectExpr(*columns)

    def sale_lines(self, window: DateRange) -> DataFrame:
        """Prices are converted once per order and part, before the joins repeat them per line."""
        sold = self._source("orders").filter(window.covers("o_orderdate")).selectExpr(*INVOICE)
        priced = self._source("part").selectExpr("p_partkey", "cast(p_retailprice as decimal(18,2)) as UNITPRICE")
        return (
            sold.join(self._source("lineitem"), F.col("ID") == F.col("l_orderkey"))
            .join(priced, F.col("p_partkey") == F.col("l_partkey"))
            .selectExpr(*sold.columns, "UNITPRICE", *LINE_ITEM)
        )


def load(spark: SparkSession, root: str) -> Clinic:
    return OrderTablesClinic(spark, root)


def view_sql() -> dict[str, str]:
    """The same views as SQL text over the source tables."""
    views = {name: f"select {', '.join(columns)} from {source}" for name, (columns, source) in VIEWS.items()}
    views["users"] = (
        f"select distinct {', '.join(DISPENSERS)} from orders"
        f" union all select distinct {', '.join(OPTOMETRISTS)} from orders"
    )
    return views
