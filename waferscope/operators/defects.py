"""Defect load per wafer, the Pareto, and how the mix differs for a cohort.

Defects are counted per inspection before they meet any other table, so an inspection or wafer that
holds a large part of all defects costs one row per defect type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from waferscope.functions.decimals import pct, pct_or_null
from waferscope.operators.cohort import Suspect, Tables, cohort_through, flag_cohort


def defects_by_wafer_and_type(tables: Tables) -> DataFrame:
    """``wafer_id, defect_type_id, found``."""
    per_inspection = tables["defects"].groupBy("inspection_id", "defect_type_id").agg(
        F.count(F.lit(1)).alias("found")
    )
    headers = tables["defect_inspections"].select("inspection_id", "wafer_id")
    return (
        per_inspection.join(headers, "inspection_id")
        .groupBy("wafer_id", "defect_type_id")
        .agg(F.sum("found").alias("found"))
    )


def wafer_defects(tables: Tables) -> DataFrame:
    """Defects per wafer; wafers without any are kept with 0.

    Tables that hold it already, as ``v_wafer_defects``, are read instead of the defects.
    """
    if "v_wafer_defects" in tables:
        return tables["v_wafer_defects"]
    per_inspection = tables["defects"].groupBy("inspection_id").agg(F.count("defect_id").alias("found"))
    headers = tables["defect_inspections"].select("inspection_id", "wafer_id")
    per_wafer = (
        per_inspection.join(headers, "inspection_id").groupBy("wafer_id").agg(F.sum("found").alias("found"))
    )
    return (
        tables["wafers"]
        .select("wafer_id")
        .join(per_wafer, "wafer_id", "left")
        .select("wafer_id", F.coalesce("found", F.lit(0)).alias("defect_count"))
    )


def defect_pareto(tables: Tables, killers_only: bool = False) -> DataFrame:
    """Share and running share per defect type, most frequent first; of killer types only if so asked.

    Equal counts are ordered by name, so the running share does not depend on row order. The windows
    run over one row per defect type.
    """
    types = tables["defect_types"].select("defect_type_id", "defect_name", "category", "is_killer")
    if killers_only:
        types = types.filter("is_killer")
    counts = (
        tables["defects"]
        .groupBy("defect_type_id")
        .agg(F.count(F.lit(1)).alias("found"))
        .join(types, "defect_type_id")
        .groupBy("defect_name", "category", "is_killer")
        .agg(F.sum("found").alias("defect_count"))
    )
    ranked = Window.orderBy(F.desc("defect_count"), "defect_name", "category", "is_killer")
    running = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("defect_count").over(Window.partitionBy())
    return counts.select(
        "defect_name",
        "category",
        "is_killer",
        "defect_count",
        pct(F.col("defect_count"), total).alias("pct_of_total"),
        pct(F.sum("defect_count").over(running), total).alias("cumulative_pct"),
    ).orderBy(F.desc("defect_count"), "defect_name")


def defect_mix_by_cohort(tables: Tables, suspect: Suspect) -> DataFrame:
    """Each type's share within the suspect's wafers and within all others; NULL for an empty group."""
    flagged = flag_cohort(defects_by_wafer_and_type(tables), cohort_through(tables, suspect))
    counts = (
        flagged.groupBy("defect_type_id")
        .agg(
            F.sum(F.when(F.col("in_cohort"), F.col("found")).otherwise(0)).alias("bad"),
            F.sum(F.when(F.col("in_cohort"), 0).otherwise(F.col("found"))).alias("others"),
        )
        .join(tables["defect_types"].select("defect_type_id", "defect_name"), "defect_type_id")
        .groupBy("defect_name")
        .agg(F.sum("bad").alias("bad"), F.sum("others").alias("others"))
    )

    def share(column: str) -> Column:
        return pct_or_null(F.col(column), F.sum(column).over(Window.partitionBy()))

    return counts.select(
        "defect_name", share("bad").alias("pct_bad_group"), share("others").alias("pct_others_group")
    ).orderBy(F.desc("pct_bad_group"), "defect_name")


def defect_sizes(tables: Tables) -> DataFrame:
    """Smallest, mean and largest size per defect type, largest mean first; types without sized defects have none."""
    sizes = tables["defects"].groupBy("defect_type_id").agg(
        F.count(F.lit(1)).alias("defect_count"),
        F.count("defect_size_um").alias("sized"),
        F.min("defect_size_um").alias("smallest_um"),
        F.avg("defect_size_um").cast("decimal(10,4)").alias("mean_um"),
        F.max("defect_size_um").alias("largest_um"),
    )
    types = tables["defect_types"].select("defect_type_id", "defect_name", "is_killer")
    return (
        sizes.join(types, "defect_type_id")
        .select("defect_name", "is_killer", "defect_count", "sized", "smallest_um", "mean_um", "largest_um")
        .orderBy(F.desc_nulls_last("mean_um"), "defect_name")
    )
