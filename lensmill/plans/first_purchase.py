"""An index of every patient's first purchase in a fiscal year, for the count of first-time customers.

The table is partitioned by the day of that first purchase. A report over a window reads the window's days alone and counts
them; no invoice is read again. New days are merged in: a patient's row is written where the first purchase now lies, and
taken out of the day where it lay before, so days may arrive in any order. Only the days that change are rewritten.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lensmill.functions.windows import DateRange, fiscal_year_start
from lensmill.operators.tally import Fact, Metric, tally
from lensmill.plans.branch import BY_BRANCH, roster
from lensmill.sources.catalog import Clinic

_ROWS = "patient bigint, first_sale timestamp_ntz, fiscal_year date, day date"


def _fiscal_year(instant: Column) -> Column:
    """The first day of the fiscal year."""
    return F.add_months(F.trunc(F.add_months(instant.cast("date"), -6), "year"), 6)


class Index:
    """The index under ``root``, a folder that all executors see."""

    def __init__(self, spark: SparkSession, clinic: Clinic, root: str):
        self.spark, self.clinic, self.root = spark, clinic, root

    def _stored(self) -> DataFrame:
        rows = self.spark.read.schema(_ROWS).parquet(self.root)
        return rows.filter(F.col("patient").isNotNull())

    def _exists(self) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def update(self, days: DateRange) -> None:
        """Takes in the invoices of the days: new ones, or ones that came late. Invoices that were deleted are not taken
        back; for that, write the fiscal year to a new folder."""
        beyond = DateRange(days.first, days.last + timedelta(days=1))
        sold = self.clinic.within("invoice", "SALE_DATE", beyond).filter("PATIENTID is not null")
        sold = sold.filter(F.col("SALE_DATE").cast("date") <= F.lit(days.last))
        year = _fiscal_year(F.col("SALE_DATE")).alias("fiscal_year")
        new = sold.groupBy(F.col("PATIENTID").alias("patient"), year).agg(F.min("SALE_DATE").alias("new_sale"))
        if self._exists():
            # Only fiscal years that the days lie in are met.
            years = F.col("fiscal_year").between(F.lit(fiscal_year_start(days.first)), F.lit(fiscal_year_start(days.last)))
            old = self._stored().filter(years).select("patient", "fiscal_year", F.col("first_sale").alias("old_sale"))
        else:
            old = self.spark.createDataFrame([], "patient bigint, fiscal_year date, old_sale timestamp_ntz")
        merged = old.join(new, ["patient", "fiscal_year"], "full_outer").withColumn("first_sale", F.least("old_sale", "new_sale"))
        day = F.col("first_sale").cast("date")
        changed = merged.filter("old_sale is null or new_sale < old_sale")
        # Days that gain a patient or lose one: at most those of the fiscal years met.
        lists = changed.select(F.explode(F.array(day, F.col("old_sale").cast("date"))).alias("day"))
        days_changed = [r.day for r in lists.filter("day is not null").distinct().collect()]
        if not days_changed:
            return
        rows = merged.select("patient", "first_sale", "fiscal_year", day.alias("day")).filter(F.col("day").isin(days_changed))
        # A day that lost all of its patients is replaced too.
        every = self.spark.createDataFrame([(d,) for d in days_changed], "day date")
        empty = every.select(F.lit(None).cast("bigint").alias("patient"), F.lit(None).cast("timestamp_ntz").alias("first_sale"), "day")
        empty = empty.withColumn("fiscal_year", _fiscal_year(F.col("day")))
        rows.unionByName(empty).hint("rebalance", "day").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("fiscal_year", "day").parquet(self.root)

    def unique_customers(self, window: DateRange, branches: DataFrame, exclusive: bool = False) -> DataFrame:
        """As ``branch.unique_customers_fy``: patients whose first purchase since the start of the window's fiscal year lies
        in the window, after its first instant (``exclusive``: or at it), by their home branch."""
        first_year, last_year = fiscal_year_start(window.first), fiscal_year_start(window.last)
        sold = F.col("first_sale")
        inside = (sold >= window.start) if exclusive else (sold > window.start)
        rows = self._stored().filter(F.col("fiscal_year").between(F.lit(first_year), F.lit(last_year)))
        if first_year == last_year:
            seen = rows.filter(F.col("day").between(F.lit(window.first), F.lit(window.last)))
        else:
            # The window goes into another fiscal year: an earlier purchase may lie in the first one.
            seen = rows.filter(F.col("day") <= F.lit(window.last)).groupBy("patient").agg(F.min("first_sale").alias("first_sale"))
        home = self.clinic["patient"].select("ID", "BRANCH_IDENTIFIER")
        new = seen.filter(inside & (sold <= window.end)).join(home, F.col("patient") == F.col("ID"))
        return tally([Fact(new, BY_BRANCH, [Metric("unique_cx", "count", of="patient")])], roster(branches))
