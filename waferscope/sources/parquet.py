"""Reading and fully refreshing a set of fab tables kept as Parquet, as folders or as bucketed tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from waferscope.operators.defects import wafer_defects
from waferscope.operators.yields import wafer_yield
from waferscope.sources.contract import TABLES, conform
from waferscope.sources.lazy import LazyTables

# The facts every fact-to-fact join meets on are laid out by wafer, so that scans of a wafer range
# skip files and the row groups of one wafer sit together.
CLUSTERED_BY = {
    "process_runs": ("wafer_id", "process_step_id"),
    "bin_results": ("wafer_id", "die_x", "die_y"),
    "defect_inspections": ("wafer_id",),
}

# The base measures, under the names of their views.
MEASURES = {"v_wafer_yield": wafer_yield, "v_wafer_defects": wafer_defects}


def read_fab(spark: SparkSession, folder: str) -> LazyTables:
    """The twelve tables under ``folder``. The contract gives the schema, so no footer is read for it."""
    return LazyTables(
        {
            name: lambda name=name: spark.read.schema(TABLES[name].ddl()).parquet(f"{folder}/{name}")
            for name in TABLES
        }
    )


def write_fab(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Replace each given table, parents before children.

    Range partitioning on several columns lets one hot wafer spread over files instead of landing in
    a single task.
    """
    for name in TABLES:
        if name not in tables:
            continue
        df = conform(tables[name], name)
        keys = CLUSTERED_BY.get(name)
        if keys:
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def _qualified(spark: SparkSession, name: str) -> str:
    """The catalogue table, not a temporary view of the same name."""
    return f"{spark.catalog.currentDatabase()}.{name}"


def save_tables(
    tables: Mapping[str, DataFrame], folder: str, buckets: int, spread: Collection[str] = ()
) -> None:
    """Replace catalogue tables kept under ``folder``, with the facts bucketed and sorted by wafer.

    Facts bucketed alike meet on the wafer without a shuffle. A bucket is read by one task, so facts in which
    a wafer may outweigh a bucket are named in ``spread`` and written as ``write_fab`` does.
    """
    for name in TABLES:
        if name not in tables:
            continue
        df = conform(tables[name], name)
        target = f"{folder}/{name}"
        keys = CLUSTERED_BY.get(name)
        if keys and name not in spread:
            writer = df.repartition(buckets, "wafer_id").write.bucketBy(buckets, "wafer_id").sortBy("wafer_id")
        elif keys:
            writer = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write
        else:
            writer = df.write
        writer.mode("overwrite").option("path", target).saveAsTable(_qualified(df.sparkSession, name))


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that the whole cluster shares: in spark.checkpoint.dir. Where that is unset, this machine's own if all
    tasks run on it, and an error on a cluster, whose executors would each write to a folder of their own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/fab-{uuid.uuid4().hex}"
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    return f"file://{tempfile.mkdtemp(prefix='fab-')}"


def with_measures(tables: Mapping[str, DataFrame], folder: str) -> LazyTables:
    """The tables with yield and defects per wafer, computed once, kept under ``folder`` and read from there.

    Every analysis of a report then starts from a row per wafer instead of all dies and defects.
    """
    kept = {}
    for name, measure in MEASURES.items():
        df = measure(tables)
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        kept[name] = (lambda spark, ddl, path: lambda: spark.read.schema(ddl).parquet(path))(
            df.sparkSession, df.schema, f"{folder}/{name}"
        )
    return LazyTables({**{name: lambda name=name: tables[name] for name in tables}, **kept})


def saved_tables(spark: SparkSession) -> LazyTables:
    """The tables ``save_tables`` left in the session's catalogue."""
    return LazyTables({name: lambda name=name: spark.table(_qualified(spark, name)) for name in TABLES})
