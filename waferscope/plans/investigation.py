"""The whole investigation: rule out, find the chamber, confirm it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waferscope.operators.cohort import Suspect, Tables
from waferscope.operators.commonality import commonality_rank, find_suspect, suspect_vs_peers
from waferscope.operators.correlation import cohort_fingerprint, yield_by_defect_band
from waferscope.operators.defects import defect_mix_by_cohort, defect_pareto, defect_sizes
from waferscope.operators.spc import capability, spc_by_chamber, spc_by_tool, spc_group_shift, spc_limits, spc_run_rules
from waferscope.operators.yields import yield_by_lot, yield_by_node, yield_by_product, yield_by_tool, yield_by_zone


def investigate(tables: Tables, suspect: Suspect | None = None) -> dict[str, DataFrame]:
    """Every analysis in the order an investigation takes, then those that look further. Without a suspect, the worst
    chamber is one. Given tables from ``sources.parquet.with_measures``, dies and defects are not reread for each."""
    suspect = suspect or Suspect.from_row(find_suspect(tables))
    return {
        "yield_by_lot": yield_by_lot(tables),
        "yield_by_product": yield_by_product(tables),
        "yield_by_node": yield_by_node(tables),
        "yield_by_tool": yield_by_tool(tables),
        "defect_pareto": defect_pareto(tables),
        "spc_limits": spc_limits(tables),
        "spc_by_tool": spc_by_tool(tables),
        "commonality_rank": commonality_rank(tables),
        "suspect_vs_peers": suspect_vs_peers(tables, suspect),
        "defect_mix_by_cohort": defect_mix_by_cohort(tables, suspect),
        "spc_group_shift": spc_group_shift(tables, suspect),
        "yield_by_defect_band": yield_by_defect_band(tables),
        "cohort_fingerprint": cohort_fingerprint(tables, suspect),
        "yield_by_zone": yield_by_zone(tables),
        "killer_pareto": defect_pareto(tables, killers_only=True),
        "defect_sizes": defect_sizes(tables),
        "spc_by_chamber": spc_by_chamber(tables),
        "spc_run_rules": spc_run_rules(tables),
        "capability": capability(tables),
    }
