"""Clearing eligibility marks that an appointment further ahead makes stale."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lensmill.functions.exprs import ntz
from lensmill.sources.catalog import Clinic

# Category codes that mark eligibility (fixed values).
ELIGIBILITY_CODES = ("ME", "MNE")


def _marked(clinic: Clinic, as_of: date, days_ahead: int) -> DataFrame:
    """Category rows with ``clear``: true where the row is an eligibility mark to be removed."""
    horizon = ntz(f"{as_of + timedelta(days=days_ahead)} 00:00:00")
    booked = (
        clinic["appointment"]
        .filter(F.col("STARTDATE") > horizon)
        .select(F.col("PATIENTID").alias("_booked"))
        .filter("_booked is not null")
        .distinct()
    )
    links = clinic["patient_categories_link"]
    code = F.coalesce(F.col("IDENTIFIER").isin(*ELIGIBILITY_CODES), F.lit(False))
    return links.join(booked, F.col("PATIENT_ID") == F.col("_booked"), "left").select(
        *links.columns, (code & F.col("_booked").isNotNull()).alias("clear")
    )


def eligibility_cleared(clinic: Clinic, as_of: date, days_ahead: int = 3) -> DataFrame:
    """The rows to delete: eligibility marks of patients with an appointment past the horizon."""
    return _marked(clinic, as_of, days_ahead).filter("clear").drop("clear")


def eligibility_kept(clinic: Clinic, as_of: date, days_ahead: int = 3) -> DataFrame:
    """The rows that stay, other categories of the same patients included."""
    return _marked(clinic, as_of, days_ahead).filter("not clear").drop("clear")


def eligibility_cleared_count(clinic: Clinic, as_of: date, days_ahead: int = 3) -> DataFrame:
    return eligibility_cleared(clinic, as_of, days_ahead).agg(F.count("*").alias("cleared"))


#: Partitions of the stored table of category rows.
PARTS = 64


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("PATIENT_ID"), F.lit(parts)).cast("int").alias("part")


def write_categories(links: DataFrame, root: str, parts: int = PARTS) -> None:
    """Stores category rows by patient, so that clearing some patients' marks rewrites few partitions."""
    rows = links.select("*", _part(parts))
    rows.hint("rebalance", "part").write.partitionBy("part").parquet(root)


def clear_eligibility(
    spark: SparkSession, clinic: Clinic, as_of: date, root: str, work: str, days_ahead: int = 3, parts: int = PARTS
) -> dict[str, int]:
    """Deletes the marks from the table that ``write_categories`` stored under ``root``; returns how many rows were
    ``cleared`` and how many were looked at.

    The rows to delete are found in one pass and left in ``work/cleared``. Only partitions that lose a row are written
    again, first to ``work/kept`` and from there in place; the files of the others are not touched. A job that was stopped
    is run again with a new ``work``: rows that are gone already are not found again.
    """
    stored = spark.read.parquet(root)
    seen = Observation("eligibility")
    here = Clinic({"appointment": clinic["appointment"], "patient_categories_link": stored})
    marked = _marked(here, as_of, days_ahead).observe(
        seen, F.count("*").alias("rows"), F.count(F.when(F.col("clear"), 1)).alias("cleared")
    )
    marked.filter("clear").drop("clear").write.parquet(f"{work}/cleared")
    cleared = spark.read.schema(stored.schema).parquet(f"{work}/cleared")
    touched = [r.part for r in cleared.select("part").distinct().collect()]  # at most ``parts`` numbers
    if touched:
        in_touched = Clinic({"appointment": clinic["appointment"], "patient_categories_link": stored.filter(F.col("part").isin(touched))})
        # A partition that loses all of its rows is replaced too, by a row that is no category.
        every = spark.createDataFrame([(p,) for p in touched], "part int")
        kept = _marked(in_touched, as_of, days_ahead).filter("not clear").drop("clear").unionByName(every, allowMissingColumns=True)
        kept.hint("rebalance", "part").write.parquet(f"{work}/kept")
        again = spark.read.schema(stored.schema).parquet(f"{work}/kept").hint("rebalance", "part")
        again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(root)
    return {"cleared": seen.get["cleared"], "rows": seen.get["rows"]}


def read_categories(spark: SparkSession, root: str) -> DataFrame:
    """The stored category rows."""
    # A row without a patient and a code says only that its partition is there.
    return spark.read.parquet(root).filter("PATIENT_ID is not null or IDENTIFIER is not null").drop("part")
