"""The thirteen practice tables: schemas, loading, and window-limited access."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lensmill.functions.windows import DateRange

SCHEMAS: dict[str, str] = {
    "invoice": "ID bigint, PATIENTID bigint, SALE_DATE timestamp_ntz, BRANCH_IDENTIFIER string, USER_ADDED string, "
    "USER_IDENTIFIER string, TYPE int, DESPENSE_TOTAL decimal(18,2), ORDER_TYPE int, DISCOUNTID int, "
    "STOCK_CHARGED decimal(18,2), STOCK_PAID decimal(18,2)",
    "invoice_items": "INVOICEID bigint, QTY int, UNITPRICE decimal(18,2), DISCOUNT_AMOUNT decimal(18,4), "
    "STOCK_TYPE int, ITEM_BARCODE string",
    "patient": "ID bigint, BRANCH_IDENTIFIER string, MEMBER_NUMBER string, TITLE string, GIVEN string, "
    "SURNAME string, EMAIL string, NOEMAIL boolean, BIRTHDATE date",
    "appointment": "ID bigint, PATIENTID bigint, STARTDATE timestamp_ntz, ENDDATE timestamp_ntz, "
    "BRANCH_IDENTIFIER string, RESID string, APPOINTMENT_TYPE string, APP_PROGRESS int",
    "spectacle_orders": "ID bigint, PATIENTID bigint, ORDER_DATE timestamp_ntz, COLLECTED_DATE timestamp_ntz, "
    "BRANCH_IDENTIFIER string, DELIVERY_BRANCH string, WARRANTY string, CANCELLED int, USER_ADDED string, "
    "STAFFFIT string, STAFFCHK string, STAFFPCK string, STAFFDEL string",
    "contact_lens_orders": "ID bigint, PATIENTID bigint, ORDER_DATE timestamp_ntz, COLLECTED_DATE timestamp_ntz, "
    "FOLLOWED_UP_DATE timestamp_ntz, BRANCH_IDENTIFIER string, USER_ADDED string, CANCELLED int, TRIAL int, "
    "TRIAL_ONLY int, WARRANTY string, RX_REFERENCE bigint",
    "contact_rx": "ID bigint, PATIENTID bigint, DATE_ADDED timestamp_ntz, EXPIRY_DATE timestamp_ntz",
    "examination": "ID bigint, PATIENT_ID bigint, EXAM_DATE timestamp_ntz, USER_IDENTIFIER string",
    "clockinout": "TIMESTMP timestamp_ntz, BRANCH_IDENTIFIER string, USER_ADDED string",
    "patient_letters": "ID bigint, DATE_ADDED timestamp_ntz, USER_ADDED string, LETTER_DESCRIPTION string",
    "stock_arrival": "ID bigint, ARRIVAL_DATE timestamp_ntz, BRANCH_IDENTIFIER string, USER_ADDED string",
    "users": "IDENTIFIER string, USER_TYPE int, INACTIVE int, GIVEN_NAME string, SURNAME string",
    "patient_categories_link": "PATIENT_ID bigint, IDENTIFIER string",
}

# The date a fact is laid out by (see layout.py).
FACT_DATES: dict[str, str] = {
    "invoice": "SALE_DATE",
    "appointment": "STARTDATE",
    "spectacle_orders": "ORDER_DATE",
    "contact_lens_orders": "ORDER_DATE",
    "contact_rx": "DATE_ADDED",
    "examination": "EXAM_DATE",
    "clockinout": "TIMESTMP",
    "patient_letters": "DATE_ADDED",
    "stock_arrival": "ARRIVAL_DATE",
}


class Clinic:
    """Named tables. Reports ask for ``within(table, column, window)`` and ``sale_lines(window)``.

    A table may be given as a function, which is called when a report first asks for it.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._tables = dict(tables)

    def __getitem__(self, name: str) -> DataFrame:
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = check_schema(name, table())
        return table

    def within(self, name: str, column: str, window: DateRange) -> DataFrame:
        """Rows whose date column lies in the window; also prunes month partitions where laid out."""
        return _in_months(self[name], column, window).filter(window.covers(column))

    def sale_lines(self, window: DateRange) -> DataFrame:
        """Invoices of the window joined with their items, one row per item."""
        invoice = self.within("invoice", "SALE_DATE", window)
        items = _in_months(self["invoice_items"], "SALE_DATE", window)
        month = month_column("SALE_DATE")
        return invoice.drop(month).join(items.drop(month), F.col("ID") == F.col("INVOICEID"))


def month_column(date_column: str) -> str:
    return f"{date_column}_MONTH"


def _in_months(frame: DataFrame, column: str, window: DateRange) -> DataFrame:
    month = month_column(column)
    return frame.filter(F.col(month).between(*window.months)) if month in frame.columns else frame


def check_schema(name: str, frame: DataFrame) -> DataFrame:
    """Refuses a table that lacks a column or holds it in another type."""
    have = {f.name.upper(): f.dataType for f in frame.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, got {have[f.name].simpleString() if f.name in have else 'nothing'}"
        for f in StructType.fromDDL(SCHEMAS[name]).fields
        if have.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"table {name}: " + "; ".join(wrong))
    return frame


def load_parquet(spark: SparkSession, root: str) -> Clinic:
    """One parquet directory per table under ``root``."""
    return Clinic({name: partial(spark.read.parquet, f"{root}/{name}") for name in SCHEMAS})


# What a table's scan can be split by: a number or a date that spreads its rows.
SPLIT_COLUMNS: dict[str, str] = {name: "ID" for name, ddl in SCHEMAS.items() if ddl.startswith("ID ")} | {
    "invoice_items": "INVOICEID",
    "clockinout": "TIMESTMP",
    "patient_categories_link": "PATIENT_ID",
}


def jdbc_options(
    url: str, table: str, key: str | None = None, low: object = 0, high: object = 0, parts: int = 64
) -> dict[str, str]:
    """Reader options that split one table scan into ``parts`` range queries on a number or date column."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", "preferTimestampNTZ": "true"}
    if key:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return options


def quantile_bounds(histogram: Sequence[tuple[object, int]], parts: int) -> list[object]:
    """Bounds that cut a column's values into at most ``parts`` ranges of about equal rows.

    histogram: (value, rows) of buckets, each named by its least value, in any order, as one grouped query on the
    database gives it. A bucket is not cut, so there are fewer ranges where one holds more than its share.
    """
    buckets = sorted(histogram)
    share = sum(n for _, n in buckets) / max(parts, 1)
    bounds, rows = [], 0
    for value, n in buckets:
        if rows >= share * (len(bounds) + 1):
            bounds.append(value)
        rows += n
    return bounds


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """One condition per range between the bounds: the ranges hold every row once, those without a value too."""

    def literal(value: object) -> str:
        return str(value) if isinstance(value, int | float | Decimal) else "'" + str(value).replace("'", "''") + "'"

    if not bounds:
        return ["1 = 1"]
    ends = [literal(b) for b in bounds]
    inner = [f"{column} >= {a} and {column} < {b}" for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return [f"{column} < {ends[0]} or {column} is null", *inner, f"{column} >= {ends[-1]}"]


def split_by(name: str, key_ranges: Mapping[str, tuple]) -> tuple[str | None, object, object]:
    """(column, low, high) for one table; no column where it is read in one query."""
    if name not in key_ranges:
        return None, 0, 0
    *column, low, high = key_ranges[name]
    key = column[0] if column else SPLIT_COLUMNS.get(name)
    known = [f.name for f in StructType.fromDDL(SCHEMAS[name]).fields]
    if key not in known:
        raise ValueError(f"table {name} can't be split by {key}: it has {', '.join(known)}")
    return key, low, high


def load_jdbc(
    spark: SparkSession,
    url: str,
    key_ranges: Mapping[str, tuple],
    parts: int = 64,
    schema: str = "dbo",
    properties: Mapping[str, str] | None = None,
    histograms: Mapping[str, tuple[str, Sequence[tuple[object, int]]]] | None = None,
) -> Clinic:
    """Tables of a live database. Filters and column lists are pushed into the generated SQL.

    ``key_ranges`` gives (min, max) of the split column per large table (see SPLIT_COLUMNS), or (column, min, max) to
    split by another column; rows outside the bounds are read too. ``histograms`` gives (column, [(value, rows)]) of tables
    whose split column is uneven: their ranges hold about equal rows. Other tables are read in one query.
    """

    def table(name: str) -> DataFrame:
        options = jdbc_options(url, f"{schema}.{name.upper()}", *split_by(name, key_ranges), parts)
        options |= dict(properties or {})
        if name in (histograms or {}):
            column, histogram = histograms[name]
            split_by(name, {name: (column, None, None)})  # refuses a column the table lacks
            plain = {k: v for k, v in options.items() if k not in ("partitionColumn", "lowerBound", "upperBound", "numPartitions", "url", "dbtable")}
            frame = spark.read.jdbc(url, options["dbtable"], predicates=range_predicates(column, quantile_bounds(histogram, parts)), properties=plain)
        else:
            frame = spark.read.format("jdbc").options(**options).load()
        wanted = StructType.fromDDL(SCHEMAS[name]).fields
        return frame.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))

    return Clinic({name: partial(table, name) for name in SCHEMAS})
