"""Checks that a load is complete and that the cohort's signal is in every table it should be in."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from waferscope.functions.decimals import MEAN_COUNT, MEAN_READING, count_if, mean_of_sums
from waferscope.operators.cohort import Suspect, Tables, cohort_through, flag_cohort
from waferscope.operators.spc import readings

# Status words and signal names that reports are read by.
OK, MISMATCH, CHECK = "OK", "**MISMATCH**", "**CHECK**"
RECONCILED = "OK (rows = sum of counts)"
DEFECT_SIGNAL, YIELD_SIGNAL, METRIC_SIGNAL = "B1 defect_count", "B2 die_yield_pct", "B3 "
OTHERS = "others"


def _expected(value: int | Column) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("long")


def _status(holds: Column, good: str, bad: str) -> Column:
    return F.when(holds, good).otherwise(bad).alias("status")


def row_count_check(tables: Tables, expected: Mapping[str, int | Column]) -> DataFrame:
    """Expected against actual rows per table. An expectation may be a scalar query."""

    def one(name: str, value: int | Column) -> DataFrame:
        return (
            tables[name]
            .agg(F.count(F.lit(1)).alias("actual"))
            .select(F.lit(name).alias("table_name"), _expected(value).alias("expected"), "actual")
        )

    counts = reduce(DataFrame.unionByName, [one(name, value) for name, value in expected.items()])
    return counts.select("*", _status(F.col("expected") == F.col("actual"), OK, MISMATCH)).orderBy("table_name")


def defect_reconcile(tables: Tables) -> DataFrame:
    """Detail rows against the sum of the header counts."""
    rows = tables["defects"].agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        tables["defect_inspections"]
        .agg(F.coalesce(F.sum("defect_count"), F.lit(0)).alias("must_equal_sum_counts"))
        .select(F.lit("defects").alias("table_name"), rows.alias("actual_rows"), "must_equal_sum_counts")
        .select("*", _status(F.col("actual_rows") == F.col("must_equal_sum_counts"), RECONCILED, MISMATCH))
    )


def unreconciled_inspections(tables: Tables) -> DataFrame:
    """The inspections whose header does not match their rows; totals alone can cancel."""
    rows = tables["defects"].groupBy("inspection_id").agg(F.count(F.lit(1)).alias("actual_rows"))
    headers = tables["defect_inspections"].select("inspection_id", "defect_count")
    return (
        headers.join(rows, "inspection_id", "left")
        .select("inspection_id", "defect_count", F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"))
        .filter(F.col("defect_count") != F.col("actual_rows"))
    )


def metrology_count_check(tables: Tables, expected: int | Column) -> DataFrame:
    return (
        tables["metrology_measurements"]
        .agg(F.count(F.lit(1)).alias("actual_rows"))
        .select(
            F.lit("metrology_measurements").alias("table_name"), "actual_rows", _expected(expected).alias("expected_rows")
        )
        .select("*", _status(F.col("actual_rows") == F.col("expected_rows"), OK, CHECK))
    )


def die_grid_check(tables: Tables, dies_per_wafer: int) -> DataFrame:
    """The wafers whose die count differs from the grid's; wafers without dies included, and all wafers of dies that
    ``wafers`` does not have."""
    dies = tables["bin_results"].groupBy("wafer_id").agg(F.count(F.lit(1)).alias("dies"))
    known = tables["wafers"].select("wafer_id", F.lit(True).alias("known"))
    return (
        known.join(dies, "wafer_id", "full")
        .filter(F.col("known").isNull() | (F.coalesce("dies", F.lit(0)) != dies_per_wafer))
        .select("wafer_id", F.coalesce("dies", F.lit(0)).alias("dies"))
    )


def _group(suspect: Suspect) -> Column:
    return F.when(F.col("in_cohort"), suspect.label).otherwise(OTHERS).alias("grp")


def signal_defects(tables: Tables, suspect: Suspect) -> DataFrame:
    """Mean header count of the suspect's wafers and of all others, per inspection."""
    per_wafer = (
        tables["defect_inspections"]
        .groupBy("wafer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("defect_count").alias("total"))
    )
    n, total = F.sum("n"), F.sum("total")
    return (
        flag_cohort(per_wafer, cohort_through(tables, suspect))
        .groupBy("in_cohort")
        .agg(n.alias("wafers"), mean_of_sums(total, n, 1).cast(MEAN_COUNT).alias("avg_metric"))
        .select(F.lit(DEFECT_SIGNAL).alias("signal"), _group(suspect), "wafers", "avg_metric")
    )


def signal_yield(tables: Tables, suspect: Suspect) -> DataFrame:
    """Mean of the wafers' unrounded yields: deliberately not the rounded per-wafer yield the analyses use."""
    codes = tables["bin_codes"].select("bin_code_id", "is_pass")
    share = count_if(F.col("is_pass")) * F.lit(Decimal("100.0")) / F.count(F.lit(1))
    per_wafer = (
        tables["bin_results"]
        .select("wafer_id", "bin_code_id")
        .join(codes, "bin_code_id")
        .groupBy("wafer_id")
        .agg(share.cast("decimal(10,6)").alias("yield_pct"))
    )
    return (
        flag_cohort(per_wafer, cohort_through(tables, suspect))
        .groupBy("in_cohort")
        .agg(F.count(F.lit(1)).alias("wafers"), F.avg("yield_pct").cast("decimal(6,2)").alias("avg_metric"))
        .select(F.lit(YIELD_SIGNAL).alias("signal"), _group(suspect), "wafers", "avg_metric")
    )


def signal_metrology(tables: Tables, suspect: Suspect) -> DataFrame:
    """Mean reading per metric, for the suspect's wafers and for all others."""
    per_wafer = metric_sums_by_wafer(tables)
    n, total = F.sum("n"), F.sum("total")
    return (
        flag_cohort(per_wafer, cohort_through(tables, suspect))
        .groupBy("metric_type", "in_cohort")
        .agg(n.alias("readings"), mean_of_sums(total, n, 4).cast(MEAN_READING).alias("avg_metric"))
        .select(F.concat(F.lit(METRIC_SIGNAL), "metric_type").alias("signal"), _group(suspect), "readings", "avg_metric")
        .orderBy("signal", "grp")
    )


def metric_sums_by_wafer(tables: Tables) -> DataFrame:
    """``wafer_id, metric_type, n, total``: readings summed before any cohort is joined."""
    return (
        readings(tables, "wafer_id")
        .groupBy("wafer_id", "metric_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    )
