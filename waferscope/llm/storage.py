"""Intermediate results that several jobs read: written once to the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="waferscope-")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, one of this process's own if all tasks run in it, as in tests, and an
    error on a cluster, whose executors would each write to a folder of their own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    return shared or f"file://{_own_folder()}"


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks that read the table, not the work that made it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
