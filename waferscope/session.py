"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the run-time work the operators leave to it: picking a broadcast only
# under the size threshold, splitting skewed join partitions, and coalescing small ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# For one machine and small data: few shuffle partitions, kept apart so that every core has one, no
# recording of Python call sites per column expression, and room for all the code Spark generates.
LOCAL = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.driver.extraJavaOptions": "-XX:ReservedCodeCacheSize=1g -XX:+UseParallelGC",
}


def local_session(name: str, cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {**SETTINGS, **LOCAL, "spark.driver.memory": memory, **extra}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
