"""Writes the tables so that a report reads only the months it asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lensmill.sources.catalog import FACT_DATES, SCHEMAS, Clinic, month_column


def write_monthly(clinic: Clinic, root: str, mode: str = "errorifexists") -> None:
    """Facts are partitioned by month of their date; items take the month of their invoice.

    ``load_parquet`` reads the result, and ``Clinic.within`` / ``sale_lines`` then prune partitions.
    """
    for name in SCHEMAS:
        frame = clinic[name]
        if name == "invoice_items":
            frame = _items_with_sale_month(clinic)
            part = month_column("SALE_DATE")
        elif name in FACT_DATES:
            part = month_column(FACT_DATES[name])
            frame = frame.withColumn(part, _month(FACT_DATES[name]))
        else:
            frame.write.mode(mode).parquet(f"{root}/{name}")
            continue
        # Rebalancing by month makes few files per month and splits a month that is too large for one.
        frame.hint("rebalance", part).write.mode(mode).partitionBy(part).parquet(f"{root}/{name}")


def _month(column: str) -> Column:
    """Year and month as text, whatever the session's time zone."""
    return F.col(column).cast("string").substr(1, 7)


def _items_with_sale_month(clinic: Clinic) -> DataFrame:
    dated = clinic["invoice"].select("ID", _month("SALE_DATE").alias(month_column("SALE_DATE")))
    return clinic["invoice_items"].join(dated, F.col("INVOICEID") == F.col("ID")).drop("ID")
