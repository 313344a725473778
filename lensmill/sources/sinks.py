"""Report and claim-batch writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lensmill.functions.windows import DateRange


def report_name(title: str, window: DateRange, branch: str | None = None) -> str:
    tail = f"-{branch}" if branch else ""
    return f"report-{title}-{window.first}-to-{window.last}{tail}.csv"


def write_report(report: DataFrame, root: str, title: str, window: DateRange, mode: str = "errorifexists") -> str:
    """CSV with a header row under the report's name; Spark writes a directory of that name."""
    path = f"{root}/{report_name(title, window)}"
    report.write.mode(mode).option("header", True).csv(path)
    return path


def write_report_by_branch(
    report: DataFrame, root: str, title: str, window: DateRange, mode: str = "errorifexists"
) -> str:
    """One sub-directory per branch, the branch column moved into its name."""
    path = f"{root}/{report_name(title, window)}"
    report.write.mode(mode).option("header", True).partitionBy("branch").csv(path)
    return path


def write_claim_batches(ordered: DataFrame, root: str, joined: bool = False, mode: str = "errorifexists") -> None:
    """Rewrites claim batches, one directory per batch file, from ``claims_reordered``.

    The frame is range-partitioned by batch and order, so the part files of a batch, read by name, are
    the batch in order, and a large batch is written by many tasks. Records end a line each.
    ``joined`` writes records end to end with no line breaks: every record ends in a blank, which is
    then written as the separator.
    """
    if joined:
        text = F.col("record").substr(F.lit(1), F.length("record") - 1)
    else:
        text = F.regexp_replace("record", r"\n$", "")
    batches = ordered.select(F.col("file").alias("batch"), text.alias("value"))
    batches.write.mode(mode).option("lineSep", " " if joined else "\n").partitionBy("batch").text(root)
