"""Defect load against yield, wafer by wafer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waferscope.functions.decimals import MEAN_COUNT, PERCENT, mean_of_sums, pct_or_null
from waferscope.functions.labels import ALL_OTHERS, BAD_SUFFIX
from waferscope.operators.cohort import Suspect, Tables, cohort_through, flag_cohort
from waferscope.operators.defects import defects_by_wafer_and_type, wafer_defects
from waferscope.operators.yields import wafer_yield

# Upper bound of each band and its label, two spaces included.
DEFECT_BANDS = [(3, "0-3  (low)"), (6, "4-6  (medium)"), (9, "7-9  (high)")]
TOP_BAND = "10+  (very high)"


def defect_band(count: Column) -> Column:
    band = F.when(count <= DEFECT_BANDS[0][0], DEFECT_BANDS[0][1])
    for upper, label in DEFECT_BANDS[1:]:
        band = band.when(count <= upper, label)
    return band.otherwise(TOP_BAND)


def _mean_count(total: Column, rows: Column) -> Column:
    return mean_of_sums(total, rows, 1).cast(MEAN_COUNT)


def defect_yield_points(tables: Tables) -> DataFrame:
    """One point per wafer that has dies: its defects and its yield."""
    return wafer_yield(tables).select("wafer_id", "yield_pct").join(wafer_defects(tables), "wafer_id").select(
        "wafer_id", "defect_count", "yield_pct"
    )


def defect_yield_trend(tables: Tables) -> DataFrame:
    """The straight line through the points, and their correlation, to six digits."""
    y, x = F.col("yield_pct").cast("double"), F.col("defect_count").cast("double")
    return defect_yield_points(tables).agg(
        F.count(F.lit(1)).alias("wafers"),
        F.regr_slope(y, x).cast("decimal(12,6)").alias("slope"),
        F.regr_intercept(y, x).cast("decimal(12,6)").alias("intercept"),
        F.corr(y, x).cast("decimal(12,6)").alias("correlation"),
    )


def yield_by_defect_band(tables: Tables) -> DataFrame:
    """Mean wafer yield per defect-load band, lightest band first."""
    return (
        defect_yield_points(tables)
        .groupBy(defect_band(F.col("defect_count")).alias("defect_band"))
        .agg(
            F.count(F.lit(1)).alias("wafers"),
            F.avg("yield_pct").cast(PERCENT).alias("avg_yield_pct"),
            _mean_count(F.sum("defect_count"), F.count(F.lit(1))).alias("avg_defects"),
        )
        .orderBy("avg_defects")
    )


def cohort_fingerprint(
    tables: Tables,
    suspect: Suspect,
    defect_names: tuple[str, ...] = ("Particle", "Flake"),
    share_name: str = "particle_flake_pct",
) -> DataFrame:
    """Wafers, yield, defects and, under ``share_name``, the share of the named defect types, for the cohort and all others."""
    named = (
        tables["defect_types"]
        .filter(F.col("defect_name").isin(*defect_names))
        .select("defect_type_id", F.lit(True).alias("is_named"))
    )
    per_wafer = (
        defects_by_wafer_and_type(tables)
        .join(named, "defect_type_id", "left")
        .groupBy("wafer_id")
        .agg(
            F.sum("found").alias("defect_count"),
            F.sum(F.when(F.col("is_named"), F.col("found")).otherwise(0)).alias("named_count"),
        )
    )
    profile = (
        wafer_yield(tables)
        .select("wafer_id", "yield_pct")
        .join(tables["wafers"].select("wafer_id"), "wafer_id")
        .join(per_wafer, "wafer_id", "left")
    )
    defects, named_defects = F.coalesce(F.sum("defect_count"), F.lit(0)), F.coalesce(F.sum("named_count"), F.lit(0))
    return (
        flag_cohort(profile, cohort_through(tables, suspect))
        .groupBy("in_cohort")
        .agg(
            F.count(F.lit(1)).alias("wafers"),
            F.avg("yield_pct").cast(PERCENT).alias("avg_yield_pct"),
            _mean_count(defects, F.count(F.lit(1))).alias("avg_defects"),
            pct_or_null(named_defects, defects).alias(share_name),
        )
        .select(
            F.when(F.col("in_cohort"), F.concat(suspect.label, F.lit(BAD_SUFFIX))).otherwise(ALL_OTHERS).alias("grp"),
            "wafers",
            "avg_yield_pct",
            "avg_defects",
            share_name,
        )
        .orderBy("avg_yield_pct", "grp")
    )
