"""Exclusion with the null rules of SQL ``NOT IN``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def not_in(frame: DataFrame, key: str, excluded: DataFrame, column: str) -> DataFrame:
    """Rows with ``key NOT IN (SELECT column FROM excluded)``.

    A null in the list empties the result, and a null key only passes an empty list. Spark plans a SQL
    NOT IN as a broadcast of the whole list; here the list stays distributed, reduced to one row per
    value before it is shuffled, and one aggregate tells whether it is empty or holds a null.
    """
    values = excluded.select(F.col(column).alias("_excluded"))
    total, known = F.count("*"), F.count("_excluded")
    state = values.agg(F.when(total == 0, "empty").when(known < total, "null").otherwise("plain")).scalar()
    listed = values.filter("_excluded is not null").distinct()
    open_rows = frame.filter((state == "empty") | ((state == "plain") & F.col(key).isNotNull()))
    return open_rows.join(listed, F.col(key) == F.col("_excluded"), "left_anti")
