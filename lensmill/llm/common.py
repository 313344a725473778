"""What the operators share: reading, the shared folder, stored intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: any run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else the one set on the context. On a single
    machine, which sees its own disk, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if folder or own.isDefined():
        return folder or own.get()
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/shared"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"


#: Per open job, innermost last, the folders to remove when it ends.
_JOBS: list[list[str]] = []


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored inside are removed when it ends; one stored with ``result=True`` outlives it."""
    _JOBS.append([])
    try:
        yield
    finally:
        for path in _JOBS.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(frame: DataFrame, label: str, result: bool = False) -> DataFrame:
    """Writes a frame to the shared folder and returns it reread.

    This cuts the lineage and survives lost executors. The reread table has a known size, so Spark
    broadcasts it only where it is below the session's threshold. Inside a ``job`` the folder goes with the job, a
    ``result`` with the job around it; else it is left to the owner of the shared folder, since it is read lazily.
    """
    path = new_path(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    for folders in _JOBS[-2:-1] if result else _JOBS[-1:]:
        folders.append(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Rows of a batch that goes to Python: Spark's 10,000 texts are held several times over by each task, here and in the JVM.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1024


def small_batches(spark: SparkSession) -> None:
    """Batches of few texts, unless the session has a size of its own."""
    key, rows = BATCH_ROWS
    if key not in spark.conf.getAll:
        spark.conf.set(key, rows)


#: Rows of a few numbers that one file takes.
NARROW_ROWS = 50_000


def narrow(frame: DataFrame, rows: int) -> DataFrame:
    """A frame of about so many rows of a few numbers in as few parts as it needs, but one per core.

    A part is a file where the frame is stored. On a local file system a task starts processes for each file it
    writes, to set its mode.
    """
    return frame.coalesce(max(frame.sparkSession.sparkContext.defaultParallelism, -(-rows // NARROW_ROWS)))


def n_words(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def whole_text(text: Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(text, F.lit(""))
