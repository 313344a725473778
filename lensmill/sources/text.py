"""Text files as numbered lines, whatever the file size.

A file is read in splits, so a very large one is spread over many tasks. Line numbers are rebuilt from
the split offsets: lines per split are counted, summed up per file over its splits (one row per split,
not per line), and added to the position within the split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

RAW_COLUMNS = ("path", "file", "block", "line")


def file_name() -> Column:
    return F.col("_metadata.file_name")


def folder_name() -> Column:
    """The last folder of the path, the part after ``=`` if it has one: for files Spark has written."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"/(?:[^/=]*=)?([^/=]+)/[^/]+$", 1)


def raw_lines(frame: DataFrame, name: Column | None = None) -> DataFrame:
    """Lines of a text-file frame (batch or stream) with their file and the offset of their split."""
    return frame.select(
        F.col("_metadata.file_path").alias("path"),
        (file_name() if name is None else name).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def number_lines(raw: DataFrame) -> DataFrame:
    """(path, file, line_no, line) with line_no from 1 in file order.

    The running id is consecutive within a split because it is taken directly above the scan. It also
    keeps filters above it, so the rows and the counts below see the same splits.
    """
    lines = raw.withColumn("_id", F.monotonically_increasing_id())
    splits = lines.groupBy("path", "block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("path", "block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    line_no = F.col("_before") + F.col("_id") - F.col("_first") + 1
    return lines.join(starts, ["path", "block"]).select("path", "file", line_no.alias("line_no"), "line")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return number_lines(raw_lines(spark.read.text(path)))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Enquiry responses saved as ``<env>_<kind>-<number>.txt``: (response_id, env, body).

    The response id is ``<kind>-<number>``, so the environments' answers to one enquiry share it.
    """
    whole = spark.read.text(path, wholetext=True)
    env, response_id = (F.regexp_extract(file_name(), r"^([^_]+)_(.*)\.txt$", i) for i in (1, 2))
    return whole.select(response_id.alias("response_id"), env.alias("env"), F.col("value").alias("body"))


def read_templates(spark: SparkSession, path: str, types: Sequence[str]) -> dict[str, str]:
    """The message templates of the types asked for, one ``<type>.html`` each. What else is in the folder is not read."""
    whole = spark.read.text([f"{path}/{type}.html" for type in types], wholetext=True)
    rows = whole.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.html$", "").alias("type"), "value")
    return {row["type"]: row["value"] for row in rows.collect()}


def read_template_table(spark: SparkSession, path: str, name: Column | None = None) -> DataFrame:
    """(type, template) of all ``<type>.html`` files in a folder. ``name`` gives the type where it is not the file's name."""
    whole = spark.read.option("pathGlobFilter", "*.html" if name is None else "*").text(path, wholetext=True)
    own = F.regexp_replace(F.col("_metadata.file_name"), r"\.html$", "") if name is None else name
    return whole.select(own.alias("type"), F.col("value").alias("template"))
