"""The tables and the two base measures under names that plain Spark SQL can use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from waferscope.operators.cohort import Tables
from waferscope.sources.contract import TABLES
from waferscope.sources.inline import inline_rows
from waferscope.sources.parquet import MEASURES as BASE_VIEWS


def register_views(tables: Tables) -> None:
    """Create or replace a temporary view per table and per base measure. Nothing is computed."""
    for name in TABLES:
        if name in tables:
            tables[name].createOrReplaceTempView(name)
    for name, measure in BASE_VIEWS.items():
        measure(tables).createOrReplaceTempView(name)


def views_check(spark: SparkSession) -> DataFrame:
    """``object_name, status, rows``: whether each base view is there, and its rows."""

    def one(name: str) -> DataFrame:
        if spark.catalog.tableExists(name):
            return spark.table(name).agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("object_name"), F.lit("PASS").alias("status"), "rows"
            )
        return inline_rows(spark, "object_name string, status string, rows bigint", [(name, "**CHECK**", None)])

    return reduce(DataFrame.unionByName, [one(name) for name in BASE_VIEWS])
