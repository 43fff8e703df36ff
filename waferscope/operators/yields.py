"""Yield per wafer and its die-weighted roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waferscope.functions.decimals import count_if, pct
from waferscope.operators.cohort import Tables
from waferscope.operators.shaping import GRID_SIDE, radial_zone


def wafer_yield(tables: Tables) -> DataFrame:
    """Yield of every wafer that has tested dies. ``yield_pct`` is rounded here, before anything averages it.

    Tables that hold it already, as ``v_wafer_yield``, are read instead of the dies.
    """
    if "v_wafer_yield" in tables:
        return tables["v_wafer_yield"]
    codes = tables["bin_codes"].select("bin_code_id", "is_pass")
    return (
        tables["bin_results"]
        .select("wafer_id", "bin_code_id")
        .join(codes, "bin_code_id")
        .groupBy("wafer_id")
        .agg(F.count(F.lit(1)).alias("total_dies"), count_if(F.col("is_pass")).alias("pass_dies"))
        .withColumn("yield_pct", pct(F.col("pass_dies"), F.col("total_dies")))
    )


def _die_sums(rows: DataFrame, key: str, wafers: str = "wafers") -> DataFrame:
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias(wafers),
        F.sum("total_dies").alias("total_dies"),
        F.sum("pass_dies").alias("pass_dies"),
    )


def _weighted_yield():
    return pct(F.col("pass_dies"), F.col("total_dies")).alias("yield_pct")


def _sums_by_lot(tables: Tables) -> DataFrame:
    """Die sums per lot with the lot's attributes. Wafers are summed before lots are joined."""
    sums = _die_sums(wafer_yield(tables).join(tables["wafers"].select("wafer_id", "lot_id"), "wafer_id"), "lot_id")
    lots = tables["lots"].select("lot_id", "lot_number", "product", "technology_node")
    return sums.join(lots, "lot_id")


def yield_by_lot(tables: Tables) -> DataFrame:
    """Worst lots first."""
    return (
        _sums_by_lot(tables)
        .select(
            "lot_number", "product", "technology_node", "wafers", "total_dies", "pass_dies", _weighted_yield()
        )
        .orderBy("yield_pct", "lot_number")
    )


def _yield_by_lot_attribute(tables: Tables, attribute: str) -> DataFrame:
    return (
        _sums_by_lot(tables)
        .groupBy(attribute)
        .agg(
            F.sum("wafers").alias("wafers"),
            F.sum("total_dies").alias("total_dies"),
            F.sum("pass_dies").alias("pass_dies"),
        )
        .select(attribute, "wafers", _weighted_yield())
        .orderBy(F.desc("yield_pct"), attribute)
    )


def yield_by_product(tables: Tables) -> DataFrame:
    """Best products first."""
    return _yield_by_lot_attribute(tables, "product")


def yield_by_node(tables: Tables) -> DataFrame:
    """Best technology nodes first."""
    return _yield_by_lot_attribute(tables, "technology_node")


def yield_by_tool(tables: Tables) -> DataFrame:
    """Worst tools first. A wafer counts once for every tool it touched, however many steps it ran there."""
    touched = tables["process_runs"].select("wafer_id", "tool_id").distinct()
    sums = _die_sums(touched.join(wafer_yield(tables), "wafer_id"), "tool_id", "wafers_touched")
    return (
        sums.join(tables["tools"].select("tool_id", "tool_code", "tool_type"), "tool_id")
        .select("tool_code", "tool_type", "wafers_touched", _weighted_yield())
        .orderBy("yield_pct", "tool_code")
    )


def yield_by_zone(tables: Tables, side: int = GRID_SIDE) -> DataFrame:
    """Yield of the center, mid and edge of the die grid, best first."""
    codes = tables["bin_codes"].select("bin_code_id", "is_pass")
    sites = tables["bin_results"].select("bin_code_id", "die_x", "die_y").join(codes, "bin_code_id")
    return (
        radial_zone(sites, side)
        .groupBy("zone")
        .agg(F.count(F.lit(1)).alias("total_dies"), count_if(F.col("is_pass")).alias("pass_dies"))
        .select("zone", "total_dies", "pass_dies", _weighted_yield())
        .orderBy(F.desc("yield_pct"), "zone")
    )
