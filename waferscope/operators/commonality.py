"""Which chamber do the low-yielding wafers share?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waferscope.functions.decimals import PERCENT, mean_of_sums
from waferscope.functions.labels import PEERS, SUSPECT_PREFIX
from waferscope.functions.spread import exact_square, sigma_of_sums
from waferscope.operators.cohort import Suspect, Tables, suspect_tool
from waferscope.operators.sides import rank_by_value
from waferscope.operators.yields import wafer_yield


def _chamber_sums(tables: Tables) -> DataFrame:
    """Yields of the wafers through each chamber, summed per chamber and then named.

    A wafer counts once per chamber. Pairs are made distinct before yields are joined, so no wafer
    meets the join with more rows than there are chambers.
    """
    pairs = (
        tables["process_runs"].filter(F.col("chamber_id").isNotNull()).select("wafer_id", "chamber_id").distinct()
    )
    sums = (
        pairs.join(wafer_yield(tables).select("wafer_id", "yield_pct"), "wafer_id")
        .groupBy("chamber_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("yield_pct").alias("total"),
            F.sum(exact_square(F.col("yield_pct"))).alias("squares"),
            F.min("yield_pct").alias("lowest"),
            F.max("yield_pct").alias("highest"),
        )
    )
    chambers = tables["chambers"].select("chamber_id", "tool_id", "chamber_code")
    tools = tables["tools"].select("tool_id", "tool_code", "tool_type")
    return sums.join(chambers, "chamber_id").join(tools, "tool_id")


def _chamber_means(tables: Tables) -> DataFrame:
    mean = mean_of_sums(F.col("total"), F.col("n"), 2).cast("decimal(9,6)")
    return _chamber_sums(tables).select(
        "tool_code", "chamber_code", F.col("n").alias("wafers_through"), mean.alias("mean_yield")
    )


def commonality_rank(tables: Tables) -> DataFrame:
    """Mean wafer yield per chamber, worst first. The rank uses the unrounded mean."""
    ranked = rank_by_value(_chamber_means(tables), "mean_yield", "worst_rank")
    return ranked.select(
        "tool_code",
        "chamber_code",
        "wafers_through",
        F.col("mean_yield").cast(PERCENT).alias("avg_yield_pct"),
        "worst_rank",
    ).orderBy("avg_yield_pct", "tool_code", "chamber_code")


def find_suspect(tables: Tables) -> DataFrame:
    """The single worst chamber: one row, ties settled by code."""
    worst = _chamber_means(tables).orderBy("mean_yield", "tool_code", "chamber_code").limit(1)
    return worst.select(
        "tool_code",
        "chamber_code",
        "wafers_through",
        F.col("mean_yield").cast(PERCENT).alias("avg_yield_pct"),
    )


def suspect_vs_peers(
    tables: Tables, suspect: Suspect, tool_type: str | None = None, peers_label: str | None = None
) -> DataFrame:
    """The suspect against every other chamber on tools of the same type.

    ``wafers`` counts wafer-chamber pairs. ``tool_type`` defaults to the type of the suspect's tool.
    """
    kind = F.lit(tool_type) if tool_type is not None else suspect_tool(tables, suspect, "tool_type")
    peers = F.lit(peers_label) if peers_label else F.concat(F.lit(PEERS[0]), kind, F.lit(PEERS[1]))
    is_suspect = (F.col("tool_code") == suspect.tool_code) & (F.col("chamber_code") == suspect.chamber_code)
    n, total = F.sum("n"), F.sum("total")
    return (
        _chamber_sums(tables)
        .filter(F.col("tool_type") == kind)
        .groupBy(is_suspect.alias("is_suspect"))
        .agg(
            n.alias("wafers"),
            mean_of_sums(total, n, 2).cast(PERCENT).alias("avg_yield_pct"),
            F.min("lowest").alias("min_yield"),
            F.max("highest").alias("max_yield"),
            sigma_of_sums(n, total, F.sum("squares")).cast(PERCENT).alias("sigma"),
        )
        .select(
            F.when(F.col("is_suspect"), F.concat(F.lit(SUSPECT_PREFIX), suspect.label)).otherwise(peers).alias("grp"),
            "wafers",
            "avg_yield_pct",
            "min_yield",
            "max_yield",
            "sigma",
        )
        .orderBy("avg_yield_pct", "grp")
    )
