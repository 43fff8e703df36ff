"""Spatial pass/fail maps for a downstream pattern classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waferscope.operators.cohort import Tables


def wafer_sites(tables: Tables) -> DataFrame:
    """Results per wafer, site and outcome: ``wafer_id, die_x, die_y, is_pass, tests``. The map in long form, for wafers
    with more sites than one row should hold."""
    codes = tables["bin_codes"].select("bin_code_id", "is_pass")
    return (
        tables["bin_results"]
        .join(codes, "bin_code_id")
        .groupBy("wafer_id", "die_x", "die_y", "is_pass")
        .agg(F.count(F.lit(1)).alias("tests"))
    )


def wafer_map(tables: Tables) -> DataFrame:
    """One row per wafer: its dies as an array of ``(die_x, die_y, is_pass, tests)`` in grid order.

    Repeated results at a site are counted first, so an array holds two entries per site of its grid at most,
    however many rows a wafer has.
    """
    return wafer_sites(tables).groupBy("wafer_id").agg(
        F.sort_array(F.collect_list(F.struct("die_x", "die_y", "is_pass", "tests"))).alias("dies")
    )
