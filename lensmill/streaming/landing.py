"""Picks up benefit report files as they arrive, each once, and again when one is re-sent."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lensmill.plans.claims import benefit_files, benefit_summary, is_summary
from lensmill.sources.text import file_name, number_lines, raw_lines

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
MANIFEST = "path string, file string, modified timestamp, batch bigint"


def benefit_landing(
    spark: SparkSession,
    incoming: str,
    target: str,
    checkpoint: str,
    branches: DataFrame,
    patients: DataFrame,
    files_per_batch: int = 10_000,
    name: Column | None = None,
) -> list[StreamingQuery]:
    """Reads the files under ``incoming`` not seen before and writes ``target/files`` and ``target/summary``.

    One query with one checkpoint lists the files without opening them; a batch writes both outputs to directories of its own
    number, opening summary reports alone, and its list of files (``target/manifest``) last. A batch repeated after a failure
    replaces its earlier output, and what has no list is not there for ``read_landed``. A file that is there again with a newer
    time is read again first, as a batch of its own with a negative number, and replaces its earlier rows.

    ``name`` gives the report's name where it is not the file's own. (A Spark file source passes over empty files.) The query
    runs until the present files are done; start it again for the next pick-up.
    """
    own_name = (file_name() if name is None else name).alias("file")
    listing = (F.col("path"), own_name, F.col("modificationTime").alias("modified"))

    def write(batch: DataFrame, number: int) -> None:
        # At most files_per_batch names; the lines of large files are split over tasks.
        found = batch.select("path", "file", "modified").toArrow()
        listed = spark.createDataFrame(found)
        opened = [r.path for r in listed.filter(is_summary()).select("path").collect()]
        if opened:
            lines = number_lines(raw_lines(spark.read.text([_plain(p) for p in opened]), name))
        else:
            lines = spark.createDataFrame([], "path string, file string, line_no bigint, line string")
        parts = {
            "files": benefit_files(listed.select("file"), branches),
            "summary": benefit_summary(lines, branches, patients),
            "manifest": listed,
        }
        for part, rows in parts.items():
            rows.write.mode("overwrite").parquet(f"{target}/{part}/batch={number}")

    known = _manifest(spark, target)
    if known is not None:
        _take_again(spark, incoming, listing, known, files_per_batch, write)
    arrivals = spark.readStream.format("binaryFile").option("maxFilesPerTrigger", files_per_batch).schema(FILE_SCHEMA)
    query = arrivals.load(incoming).select(*listing).writeStream.foreachBatch(write)
    return [query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()]


def _plain(path: str) -> str:
    """A path whose special characters name themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _take_again(spark: SparkSession, incoming: str, listing: tuple, known: DataFrame, files_per_batch: int, write) -> None:
    """Reads files again that have become newer since they were read."""
    newest = known.groupBy("path").agg(F.max("modified").alias("read_at"))
    present = spark.read.format("binaryFile").schema(FILE_SCHEMA).load(incoming).select(*listing)
    newer = present.join(newest, "path").filter("modified > read_at").drop("read_at")
    number = known.agg(F.least(F.min("batch"), F.lit(0))).first()[0]
    while waiting := newer.orderBy("modified", "path").limit(files_per_batch).collect():
        number -= 1
        write(spark.createDataFrame(waiting, newer.schema), number)
        done = {r.path for r in waiting}
        newer = newer.filter(~F.col("path").isin(done))


def _manifest(spark: SparkSession, target: str) -> DataFrame | None:
    """(path, file, modified, batch) of the batches that are whole; None before the first one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/manifest/batch=*/_SUCCESS")
    whole = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    folders = [str(status.getPath().getParent()) for status in whole or []]
    if not folders:
        return None
    return spark.read.schema(MANIFEST).option("basePath", f"{target}/manifest").parquet(*folders)


def read_landed(spark: SparkSession, target: str, part: str) -> DataFrame:
    """The rows of ``files`` or ``summary``: of whole batches alone, and of each file as it was read last."""
    known = _manifest(spark, target)
    if known is None:
        raise ValueError(f"no batch has been picked up to {target} yet")
    # A batch with a higher number is later, but one that reads files again is later than the one that read them first.
    last = known.groupBy("path").agg(F.max_by(F.struct("file", "batch"), F.struct("modified", F.abs("batch"))).alias("of"))
    valid = last.select("of.*").distinct()
    rows = spark.read.option("basePath", f"{target}/{part}").parquet(f"{target}/{part}")
    return rows.join(valid, (rows["file"] == valid["file"]) & (rows["batch"] == valid["batch"]), "left_semi").drop("batch")
