"""A full refresh that readers see whole or not at all.

The tables of a refresh go to a folder of their own, which no reader looks into. When the last of them is written, one file is added to the
manifest that names, for every table, the folder it is now read from. A refresh that ends early leaves the manifest as it was, and readers
with the version before; a reader resolves the manifest once, so that all its tables are of one version, whatever is published meanwhile.
Tables that a refresh does not bring are carried over. Earlier versions stay readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from waferscope.sources.contract import TABLES
from waferscope.sources.lazy import LazyTables
from waferscope.sources.parquet import write_fab

MANIFEST = "_manifest"
_MANIFEST_DDL = "number bigint, table_name string, folder string, rows bigint"


def published_versions(spark: SparkSession, root: str) -> DataFrame:
    """``number, table_name, folder, rows``: for each version from 1 on, its tables, where they lie and the rows written. No
    rows where nothing was published."""
    try:
        return spark.read.schema(_MANIFEST_DDL).parquet(f"{root}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST_DDL)


def _entries(spark: SparkSession, root: str, number: int | None = None) -> list:
    """One version's entries, one for each of its tables; the last version's without a number."""
    versions = published_versions(spark, root)
    wanted = F.lit(number) if number is not None else versions.agg(F.max("number")).scalar()
    found = versions.filter(F.col("number") == wanted).collect()
    if len(found) != len({entry.table_name for entry in found}):
        raise ValueError(f"two refreshes of {root} were published at once as version {found[0].number}")
    return found


def publish_fab(tables: Mapping[str, DataFrame], root: str) -> int:
    """Write the given tables as the next version and return its number.

    One refresh at a time: if two are published at once, both take the same number and readers refuse it.
    """
    given = [name for name in TABLES if name in tables]
    if not given:
        raise ValueError("a refresh needs a table")
    spark = tables[given[0]].sparkSession
    before = _entries(spark, root)
    number = 1 + max((entry.number for entry in before), default=0)
    folder = f"version-{number}-{uuid.uuid4().hex}"
    write_fab(tables, f"{root}/{folder}")

    def written(name: str) -> DataFrame:
        df = spark.read.schema(TABLES[name].ddl()).parquet(f"{root}/{folder}/{name}")
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")

    # One row for each table.
    counts = reduce(DataFrame.unionByName, [written(name) for name in given]).collect()
    entries = [(number, row.table_name, folder, row.rows) for row in counts]
    entries += [(number, entry.table_name, entry.folder, entry.rows) for entry in before if entry.table_name not in given]
    # A single file, which is there with all its rows or not at all.
    spark.createDataFrame(entries, _MANIFEST_DDL).coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")
    return number


def read_published(spark: SparkSession, root: str, number: int | None = None) -> LazyTables:
    """The tables of a version, the last one without a number, by the contract's schemas."""
    entries = _entries(spark, root, number)
    if not entries:
        raise ValueError(f"{root} has no version {number}" if number is not None else f"nothing is published in {root}")
    return LazyTables(
        {
            e.table_name: lambda e=e: spark.read.schema(TABLES[e.table_name].ddl()).parquet(f"{root}/{e.folder}/{e.table_name}")
            for e in entries
        }
    )


def version_check(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """``number, table_name, expected, actual, status``: the rows a version's tables have against those that were written."""
    tables = read_published(spark, root, number)

    def one(entry) -> DataFrame:
        rows = tables[entry.table_name].agg(F.count(F.lit(1)).alias("actual"))
        status = F.when(F.col("actual") == entry.rows, "OK").otherwise("**MISMATCH**")
        return rows.select(
            F.lit(entry.number).cast("long").alias("number"),
            F.lit(entry.table_name).alias("table_name"),
            F.lit(entry.rows).cast("long").alias("expected"),
            "actual",
            status.alias("status"),
        )

    return reduce(DataFrame.unionByName, [one(entry) for entry in _entries(spark, root, number)])
