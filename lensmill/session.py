"""Session settings the reports are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings the session's own choices override. Adaptive execution is on by default.
RUNTIME = {
    # Split a hot invoice or patient even where the split costs one more exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A scorecard's task sorts, joins and folds wide rows: in memory they take some 25 times what they take in a shuffle. Many
    # shuffle partitions, joined up to this size, keep a task's memory the same however large the tables are.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings that neither the session nor the cluster's defaults set."""
    chosen = spark.conf.getAll
    for key, value in RUNTIME.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lensmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
