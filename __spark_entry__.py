
from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_queries import oracles  # noqa: E402
from waferscope.operators import (  # noqa: E402
    attribution,
    cohort,
    commonality,
    correlation,
    defects,
    drift,
    occupancy,
    shaping,
    significance,
    spc,
    wafer_map,
    yields,
)
from waferscope.plans import audits, conclusions, key_state, load_checks, views  # noqa: E402
from waferscope.sources import contract  # noqa: E402
from waferscope.sources.lazy import LazyTables  # noqa: E402
from waferscope.sources.parquet import scratch_folder, with_measures  # noqa: E402
from waferscope.sources.star import bind_star, lot_numbers, read_star  # noqa: E402
from waferscope.sources.versions import publish_fab, read_published, version_check  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from waferscope.llm import registry as training_data  # noqa: E402
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "waferscope.llm"):
        raise
    training_data = None

Query = Callable[[SparkSession, str], DataFrame]

# A smoke run over the smallest data; queries take their folder.
FLAGSHIP_FOLDER = "/root/testdata/sf0.001"
NAMED_DEFECTS = ("error", "view")

MODULES = [
    shaping.ModuleTools("Deposition", ("AMERICA",), by_chamber=True),
    shaping.ModuleTools("CMP", ("ASIA",)),
    shaping.ModuleTools("Implant", ("ASIA",)),
    shaping.ModuleTools("Lithography", ("MIDDLE EAST",)),
    shaping.ModuleTools("Etch", ("AFRICA",), by_chamber=True),
    shaping.ModuleTools("Metrology", ("EUROPE", "ASIA")),
]


def _found(tables: LazyTables) -> cohort.Suspect:
    return cohort.Suspect.from_row(commonality.find_suspect(tables))


def _on_star(operator: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, folder: operator(bind_star(spark, folder), **params)


def _on_star_with_suspect(operator: Callable[..., DataFrame], **params) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        tables = bind_star(spark, folder)
        return operator(tables, _found(tables), **params)

    return run


# Damage that the audited copy carries, by integer arithmetic on the keys: each audit has something to find.
DAMAGE = {
    "wafers": {
        "lot_id": "CASE WHEN wafer_id % 97 = 0 THEN -1 ELSE lot_id END",
        "slot_no": "CASE WHEN wafer_id % 89 = 0 THEN 26 ELSE slot_no END",
        "wafer_scribe": "CASE WHEN wafer_id % 83 <> 0 THEN wafer_scribe END",
        "wafer_id": "CASE WHEN wafer_id % 101 = 1 THEN wafer_id - 1 ELSE wafer_id END",
    },
    "process_runs": {
        "tool_id": "CASE WHEN wafer_id % 79 = 0 THEN -1 ELSE tool_id END",
        "run_status": "CASE WHEN wafer_id % 73 = 0 THEN repeat('x', 21) ELSE run_status END",
    },
    "defect_inspections": {"defect_count": "CASE WHEN wafer_id % 16 = 0 THEN -1 ELSE defect_count END"},
    "defects": {
        "inspection_id": "CASE WHEN defect_id % 61 = 0 THEN -5 ELSE inspection_id END",
        "defect_size_um": "CASE WHEN defect_id % 50 = 0 THEN -1 ELSE defect_size_um END",
    },
    "metrology_measurements": {
        "spec_low": "CASE WHEN metric_type = 'Overlay' AND value = 0 THEN 9 ELSE spec_low END",
    },
}
LOST_READINGS = "metric_type = 'CD' AND value = 13"


def _damaged(spark: SparkSession, folder: str) -> LazyTables:
    tables = bind_star(spark, folder)

    def one(name: str) -> DataFrame:
        df = tables[name]
        changed = df.withColumns({column: F.expr(sql) for column, sql in DAMAGE.get(name, {}).items()})
        return changed.filter(f"NOT ({LOST_READINGS})") if name == "metrology_measurements" else changed

    return LazyTables({name: lambda name=name: one(name) for name in contract.TABLES})


def _on_damaged(operator: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, folder: operator(_damaged(spark, folder), **params)


def _size(df: DataFrame, divisor: int = 1) -> Column:
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.expr(f"(rows + {divisor - 1}) div {divisor}")).scalar()


def _wafer_map(spark: SparkSession, folder: str) -> DataFrame:
    maps = wafer_map.wafer_map(bind_star(spark, folder))
    site = F.transform(
        "dies",
        lambda d: F.concat_ws(":", d["die_x"], d["die_y"], F.when(d["is_pass"], "P").otherwise("F"), d["tests"]),
    )
    return maps.select("wafer_id", F.array_join(site, " ").alias("dies"))


def _apply_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Every third wafer, lot or catalogue entry loses its defaulted values, then gets them back."""
    tables = bind_star(spark, folder)
    thirds = {
        "tools": "tool_id",
        "defect_types": "defect_type_id",
        "bin_codes": "bin_code_id",
        "lots": "lot_id",
        "wafers": "wafer_id",
        "chambers": "chamber_id",
        "process_runs": "wafer_id",
        "defect_inspections": "wafer_id",
    }

    def one(name: str, number: str) -> DataFrame:
        filled = contract.default_columns(contract.TABLES[name])
        holed = tables[name].withColumns({c: F.when(F.col(number) % 3 != 0, F.col(c)) for c in filled})
        values = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in filled]
        )
        return (
            shaping.apply_defaults(holed, filled)
            .select(F.lit(name).alias("table_name"), F.inline(values))
            .groupBy("table_name", "column", "value")
            .agg(F.count(F.lit(1)).alias("rows"))
        )

    return reduce(DataFrame.unionByName, [one(name, number) for name, number in thirds.items()])


def _row_count_check(spark: SparkSession, folder: str) -> DataFrame:
    src = read_star(spark, folder)
    orders, lines, events = src["orders"], src["lineitem"], src["events"]
    expected = {
        "tools": _size(src["nation"]),
        "process_steps": 7,
        "defect_types": 5,
        "bin_codes": 8,
        "chambers": _size(src["supplier"]),
        "lots": _size(orders, 25),
        "wafers": _size(orders),
        "process_runs": _size(lines),
        "defect_inspections": _size(orders, 8),
        "bin_results": _size(lines),
        "defects": _size(events),
    }
    return load_checks.row_count_check(bind_star(spark, folder), expected)


def _metrology_count_check(spark: SparkSession, folder: str) -> DataFrame:
    src = read_star(spark, folder)
    return load_checks.metrology_count_check(
        _damaged(spark, folder), _size(src["lineitem"]) + _size(src["events"])
    )


def _view_totals_check(spark: SparkSession, folder: str) -> DataFrame:
    return conclusions.view_totals_check(bind_star(spark, folder), _size(read_star(spark, folder)["orders"]))


def _chambers_by_tool_code(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers that name their tool by code; every 40th names one that there is not."""
    number = F.when(F.col("s_suppkey") % 40 == 0, F.lit(99)).otherwise(F.col("s_nationkey"))
    return read_star(spark, folder)["supplier"].select(
        F.col("s_suppkey").alias("chamber_id"), F.concat(F.lit("NATION_"), number.cast("string")).alias("tool_code")
    )


def _resolve_keys(spark: SparkSession, folder: str) -> DataFrame:
    child = _chambers_by_tool_code(spark, folder)
    return shaping.resolve_keys(child, bind_star(spark, folder)["tools"], "tool_code", "tool_id")


def _unresolved_keys(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.unresolved_keys(_chambers_by_tool_code(spark, folder), bind_star(spark, folder)["tools"], "tool_code")


def _views_check(spark: SparkSession, folder: str) -> DataFrame:
    views.register_views(bind_star(spark, folder))
    return views.views_check(spark)


def _views_check_missing(spark: SparkSession, folder: str) -> DataFrame:
    """The check in a session that lost a view."""
    views.register_views(bind_star(spark, folder))
    spark.catalog.dropTempView("v_wafer_defects")
    return views.views_check(spark)


def _storable(tables: LazyTables) -> LazyTables:
    """The tables by the contract's types. Keys that are text in the source become numbers."""
    texts = {"process_runs": ["process_run_id"], "bin_results": ["bin_result_id"], "metrology_measurements": ["measurement_id", "process_run_id"]}

    def keyed(name: str) -> DataFrame:
        numbers = {c: F.xxhash64(F.coalesce(c, F.lit(""))) for c in texts.get(name, [])}
        return contract.conform(tables[name].withColumns(numbers), name)

    return LazyTables({name: lambda name=name: keyed(name) for name in contract.TABLES})


def _fab_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Tables published and read back: rows, and whether they are those that were written."""
    sent = _storable(bind_star(spark, folder))
    root = scratch_folder(spark)
    publish_fab(sent, root)
    back = read_published(spark, root)

    def mark(df: DataFrame) -> Column:
        return F.sum(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).cast("decimal(20,0)"))

    def one(name: str) -> DataFrame:
        before = sent[name].agg(mark(sent[name]).alias("mark")).scalar()
        after = back[name].agg(F.count(F.lit(1)).alias("rows"), mark(back[name]).alias("mark"))
        return after.select(F.lit(name).alias("table_name"), "rows", F.col("mark").eqNullSafe(before).alias("same"))

    return reduce(DataFrame.unionByName, [one(name) for name in contract.TABLES])


def _fab_versions(spark: SparkSession, folder: str) -> DataFrame:
    """All tables published, then readings alone without those that are lost: what each version has."""
    sent = _storable(bind_star(spark, folder))
    root = scratch_folder(spark)
    publish_fab(sent, root)
    publish_fab({"metrology_measurements": sent["metrology_measurements"].filter(f"NOT ({LOST_READINGS})")}, root)
    return version_check(spark, root, 1).unionByName(version_check(spark, root))


def _keys_by_load(spark: SparkSession, folder: str) -> DataFrame:
    """The damaged tables loaded in three parts, children before their parents or after, and audited with each."""
    tables, root = _damaged(spark, folder), scratch_folder(spark)
    for part in range(3):
        loaded = LazyTables(
            {
                name: lambda name=name, part=part: tables[name].filter(
                    F.pmod(F.xxhash64(contract.TABLES[name].key), F.lit(3)) == part
                )
                for name in contract.TABLES
            }
        )
        key_state.audit_load(loaded, root, buckets=16)
    return key_state.key_report(spark, root)


def _conclusions_from_measures(spark: SparkSession, folder: str) -> DataFrame:
    tables = with_measures(bind_star(spark, folder), scratch_folder(spark))
    return conclusions.conclusion_report(tables, _found(tables))


def _derive_lots(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.derive_lots(lot_numbers(read_star(spark, folder)["orders"]), node_stride=3)


def _derive_wafers(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.derive_wafers(bind_star(spark, folder)["lots"])


def _assignment_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.assignment_catalog(bind_star(spark, folder), MODULES)


def _round_robin_assign(spark: SparkSession, folder: str) -> DataFrame:
    tables = bind_star(spark, folder)
    catalog = shaping.assignment_catalog(tables, MODULES)
    return shaping.round_robin_assign(shaping.expand_route(tables, catalog), catalog).select(
        "wafer_id", "process_step_id", "process_module", "tool_id", "chamber_id"
    )


def _route_schedule(spark: SparkSession, folder: str) -> DataFrame:
    route = shaping.expand_route(bind_star(spark, folder))
    return shaping.route_schedule(route).select("wafer_id", "process_step_id", "run_start", "run_end")


def _explode_counts(spark: SparkSession, folder: str) -> DataFrame:
    headers = bind_star(spark, folder)["defect_inspections"].select("inspection_id", "defect_count")
    return shaping.explode_counts(headers)


def _metrology_long(spark: SparkSession, folder: str) -> DataFrame:
    """The stored measures of line items as readings: of the last step two metrics, of the first one."""
    lines = read_star(spark, folder)["lineitem"]
    runs = lines.withColumns(
        {
            "process_run_id": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
            "run_start": F.col("l_shipdate"),
        }
    )
    none = F.lit(None)
    measured, deposited = F.col("l_linenumber") == 7, F.col("l_linenumber") == 1
    metrics = [
        shaping.Metric("CD", measured, F.col("l_quantity"), F.lit(25), F.lit(1), F.lit(50), "nm"),
        shaping.Metric("Overlay", measured, F.col("l_discount") * 100 - 5, F.lit(0), F.lit(-5), F.lit(5), "nm"),
        shaping.Metric("Film Thickness", deposited, F.col("l_extendedprice"), none, none, none, "A"),
    ]
    return shaping.metrology_long(runs, metrics)


def _on_grid(spark: SparkSession, folder: str) -> LazyTables:
    """The tables with die rows folded into the grid."""
    tables = bind_star(spark, folder)
    folded = {"bin_results": tables["bin_results"].withColumn("die_y", F.col("die_y") % shaping.GRID_SIDE + 1)}
    return LazyTables({name: lambda name=name: folded.get(name) if name in folded else tables[name] for name in tables})


def _radial_zone(spark: SparkSession, folder: str) -> DataFrame:
    return (
        shaping.radial_zone(_on_grid(spark, folder)["bin_results"])
        .groupBy("wafer_id", "zone")
        .agg(F.count(F.lit(1)).alias("dies"), F.sum(F.col("die_x") * 100 + F.col("die_y")).alias("site_sum"))
    )


def queries() -> dict[str, Query]:
    found = _fab_queries()
    if training_data:
        found |= training_data.queries() | {"pipeline": corpus_pipeline.run}
    return found


def _fab_queries() -> dict[str, Query]:
    return {
        # analyses
        "commonality_rank": _on_star(commonality.commonality_rank),
        "wafer_yield": _on_star(yields.wafer_yield),
        "wafer_defects": _on_star(defects.wafer_defects),
        "yield_by_lot": _on_star(yields.yield_by_lot),
        "yield_by_product": _on_star(yields.yield_by_product),
        "yield_by_node": _on_star(yields.yield_by_node),
        "yield_by_tool": _on_star(yields.yield_by_tool),
        "defect_pareto": _on_star(defects.defect_pareto),
        "defect_mix_by_cohort": _on_star_with_suspect(defects.defect_mix_by_cohort),
        "spc_limits": _on_star(spc.spc_limits),
        "spc_group_shift": _on_star_with_suspect(spc.spc_group_shift),
        "spc_by_tool": _on_star(spc.spc_by_tool),
        "suspect_vs_peers": _on_star_with_suspect(commonality.suspect_vs_peers),
        "yield_by_defect_band": _on_star(correlation.yield_by_defect_band),
        "cohort_fingerprint": _on_star_with_suspect(correlation.cohort_fingerprint, defect_names=NAMED_DEFECTS),
        "wafer_map": _wafer_map,
        "wafer_sites": _on_star(wafer_map.wafer_sites),
        "yield_by_zone": lambda spark, folder: yields.yield_by_zone(_on_grid(spark, folder)),
        "killer_pareto": _on_star(defects.defect_pareto, killers_only=True),
        "defect_sizes": _on_star(defects.defect_sizes),
        "spc_by_chamber": _on_star(spc.spc_by_chamber),
        "spc_run_rules": _on_star(spc.spc_run_rules),
        "capability": _on_star(spc.capability),
        "cusum_by_tool": _on_star(drift.cusum_by_tool),
        "occupancy": _on_star(occupancy.occupancy),
        "cd_chart_points": _on_star(spc.chart_points),
        "defect_yield_points": _on_star(correlation.defect_yield_points),
        "defect_yield_trend": _on_star(correlation.defect_yield_trend),
        "find_suspect": _on_star(commonality.find_suspect),
        "chamber_significance": _on_star(significance.chamber_significance),
        "conditional_commonality": _on_star(attribution.conditional_commonality, limit=1.0),
        # contract audits
        "pk_audit": _on_damaged(audits.pk_audit),
        "unique_audit": _on_damaged(audits.unique_audit),
        "fk_audit": _on_damaged(audits.fk_audit),
        "keys_by_load": _keys_by_load,
        "check_audit": _on_damaged(audits.check_audit),
        "not_null_audit": _on_damaged(audits.not_null_audit),
        "apply_defaults": _apply_defaults,
        "contract_summary": _on_damaged(audits.contract_summary),
        # load checks
        "row_count_check": _row_count_check,
        "contract_links": _on_star(audits.contract_links),
        "defect_reconcile": _on_damaged(load_checks.defect_reconcile),
        "unreconciled_inspections": _on_damaged(load_checks.unreconciled_inspections),
        "views_check": _views_check,
        "views_check_missing": _views_check_missing,
        "fab_round_trip": _fab_round_trip,
        "fab_versions": _fab_versions,
        "metrology_count_check": _metrology_count_check,
        "signal_defects": _on_star_with_suspect(load_checks.signal_defects),
        "signal_yield": _on_star_with_suspect(load_checks.signal_yield),
        "signal_metrology": _on_star_with_suspect(load_checks.signal_metrology),
        "die_grid_check": _on_star(load_checks.die_grid_check, dies_per_wafer=4),
        # conclusion checks
        "view_totals_check": _view_totals_check,
        "check_product_flat": _on_star(conclusions.check_product_flat),
        "check_tool_trails": _on_star_with_suspect(conclusions.check_tool_trails),
        "check_metric_shift": _on_star_with_suspect(conclusions.check_metric_shift),
        "check_worst_chamber": _on_star_with_suspect(conclusions.check_worst_chamber),
        "check_band_order": _on_star(conclusions.check_band_order),
        "conclusion_report": _on_star_with_suspect(conclusions.conclusion_report),
        "conclusion_report_stored": _conclusions_from_measures,
        "check_pareto": _on_star_with_suspect(conclusions.check_pareto, defect_names=NAMED_DEFECTS),
        # shaping
        "resolve_keys": _resolve_keys,
        "unresolved_keys": _unresolved_keys,
        "derive_lots": _derive_lots,
        "derive_wafers": _derive_wafers,
        "assignment_catalog": _assignment_catalog,
        "expand_route": _on_star(shaping.expand_route),
        "round_robin_assign": _round_robin_assign,
        "route_schedule": _route_schedule,
        "cohort_through": _on_star_with_suspect(cohort.cohort_through),
        "explode_counts": _explode_counts,
        "radial_zone": _radial_zone,
        "metrology_long": _metrology_long,
    }


def entry(spark: SparkSession) -> DataFrame:
    """The chamber whose wafers yield worst, ranked, over the smallest test data."""
    return commonality.commonality_rank(bind_star(spark, FLAGSHIP_FOLDER))


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query over the same Parquet tables, written apart from the DataFrame code."""
    found = oracles()
    if training_data:
        found |= training_data.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
