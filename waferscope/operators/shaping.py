"""Operators that shape fab tables: key resolution, lots and wafers, route expansion, dealing, zones and readings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from waferscope.operators.cohort import Tables
from waferscope.sources.inline import inline_rows

# Names and offsets of the lot formula.
FIRST_LOT = 24_000
PRODUCTS = ["SoC-A17", "GPU-B20", "MEM-C10"]
NODES = ["3nm", "5nm", "7nm"]
LOT_EPOCH = "2024-01-01"
SLOTS_PER_LOT = 25

# The square die grid and the zones of its squared distance from the centre (6.5, 6.5).
GRID_SIDE = 12
MID_ZONE_BEYOND = 25
EDGE_ZONE_BEYOND = 40

# Rows of one range that a count is cut into before it is unfolded.
RANGE_ROWS = 10_000


def resolve_keys(child: DataFrame, parent: DataFrame, code: str, key: str) -> DataFrame:
    """Replace trust in literal ids: find the parent's ``key`` by its business ``code``."""
    return child.join(parent.select(code, key), code)


def unresolved_keys(child: DataFrame, parent: DataFrame, code: str) -> DataFrame:
    """The child rows ``resolve_keys`` would leave out."""
    return child.join(parent.select(code), code, "left_anti")


def apply_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill defaults where a row has NULL; see ``contract.default_columns``."""
    return df.withColumns(defaults)


def _pick(labels: Sequence[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(label) for label in labels]), (position + 1).cast("int"))


def lot_number(n: Column) -> Column:
    return F.concat(F.lit("LOT-"), (n + FIRST_LOT).cast("string"))


def derive_lots(numbers: DataFrame, node_stride: int = 1) -> DataFrame:
    """Lot attributes by formula from ``n``.

    ``node_stride`` 1 ties the technology node to the product; 3 makes the two vary independently. A lot starts
    ``n`` days after the first.
    """
    n = F.col("n")
    return numbers.select(
        "n",
        lot_number(n).alias("lot_number"),
        _pick(PRODUCTS, n % len(PRODUCTS)).alias("product"),
        _pick(NODES, F.floor(n / node_stride) % len(NODES)).alias("technology_node"),
        F.lit(SLOTS_PER_LOT).alias("planned_qty"),
        F.date_add(F.to_date(F.lit(LOT_EPOCH)), n.cast("int")).alias("start_date"),
        F.when(n % 10 == 0, "In Process").otherwise("Completed").alias("status"),
    )


def derive_wafers(lots: DataFrame, slots: int = SLOTS_PER_LOT) -> DataFrame:
    """One wafer per lot and slot, scribed with the lot number and the zero-padded slot."""
    numbered = lots.select("lot_id", "lot_number", F.explode(F.sequence(F.lit(1), F.lit(slots))).alias("slot_no"))
    return numbered.select(
        F.concat("lot_number", F.lit("."), F.lpad(F.col("slot_no").cast("string"), 2, "0")).alias("wafer_scribe"),
        "lot_id",
        "slot_no",
        F.lit("Good").alias("status"),
    )


@dataclass(frozen=True)
class ModuleTools:
    """Which tool types serve a process module, and whether work is dealt to chambers or whole tools."""

    module: str
    tool_types: tuple[str, ...]
    by_chamber: bool = False


def assignment_catalog(tables: Tables, modules: Sequence[ModuleTools]) -> DataFrame:
    """Every valid place for a module's work, numbered ``opt_no`` 1..N by code, with ``opt_count`` = N.

    Options are numbered within their tool and then offset by the options of earlier tools, so no
    ordered pass is longer than the tools of a module or the chambers of a tool.
    """
    spark = tables["tools"].sparkSession
    served = inline_rows(
        spark,
        "module string, tool_type string, by_chamber boolean",
        [(entry.module, kind, entry.by_chamber) for entry in modules for kind in entry.tool_types],
    )
    tools = tables["tools"].select("tool_id", "tool_code", "tool_type").join(served, "tool_type")
    chambers = tables["chambers"].select("tool_id", "chamber_id", "chamber_code")
    split = tools.filter("by_chamber").join(chambers, "tool_id")
    whole = tools.filter("NOT by_chamber").withColumns(
        {
            "chamber_id": F.lit(None).cast(chambers.schema["chamber_id"].dataType),
            "chamber_code": F.lit(""),
        }
    )
    listed = split.unionByName(whole)
    within = Window.partitionBy("module", "tool_code").orderBy("chamber_code")
    earlier = Window.partitionBy("module").orderBy("tool_code").rowsBetween(Window.unboundedPreceding, -1)
    per_tool = (
        listed.groupBy("module", "tool_code")
        .agg(F.count(F.lit(1)).alias("places"))
        .withColumn("offset", F.coalesce(F.sum("places").over(earlier), F.lit(0)))
        .withColumn("opt_count", F.sum("places").over(Window.partitionBy("module")))
    )
    return (
        listed.withColumn("place", F.row_number().over(within))
        .join(per_tool, ["module", "tool_code"])
        .select("module", "tool_id", "chamber_id", (F.col("offset") + F.col("place")).alias("opt_no"), "opt_count")
    )


def expand_route(tables: Tables, catalog: DataFrame | None = None) -> DataFrame:
    """Every wafer at every step of the route, with its lot's start date.

    The route, a fab's list of process steps, is one array that each wafer unfolds: no join and no shuffle of the
    expanded rows. With a catalogue, each step carries its module's ``opt_count``, joined to the steps while they
    are few; a module without options has none.
    """
    steps = tables["process_steps"].select("process_step_id", "process_module", "sequence_order")
    if catalog is not None:
        counts = catalog.filter(F.col("opt_no") == 1).select(F.col("module").alias("process_module"), "opt_count")
        steps = steps.join(counts, "process_module", "left")
    step = F.struct("sequence_order", *[c for c in steps.columns if c != "sequence_order"])
    route = steps.agg(F.sort_array(F.collect_list(step)).alias("route")).scalar()
    lots = tables["lots"].select("lot_id", "start_date")
    return (
        tables["wafers"]
        .select("wafer_id", "lot_id")
        .join(lots, "lot_id")
        .select("wafer_id", "start_date", F.inline(route))
        .select("wafer_id", "start_date", "process_step_id", "process_module", "sequence_order", *steps.columns[3:])
    )


def round_robin_assign(route: DataFrame, catalog: DataFrame, turn: Column | None = None) -> DataFrame:
    """Deal the rows of a route that was expanded with the catalogue evenly over their module's options: option
    ``turn % opt_count + 1``, joined once by module and number. ``turn`` defaults to the wafer id. Steps of a module without
    options are left out.
    """
    options = catalog.select(F.col("module").alias("process_module"), "opt_no", "tool_id", "chamber_id")
    opt_no = (turn if turn is not None else F.col("wafer_id")) % F.col("opt_count") + 1
    return (
        route.withColumn("opt_no", opt_no).join(options, ["process_module", "opt_no"]).drop("opt_no", "opt_count")
    )


def route_schedule(route: DataFrame, minutes_per_order: int = 30, run_minutes: int = 20) -> DataFrame:
    """Nominal start and end of each run: the later in the route, the later after the lot's start."""
    start = f"sequence_order * {minutes_per_order}"
    midnight = "CAST(start_date AS timestamp_ntz)"
    return route.withColumns(
        {
            "run_start": F.expr(f"timestampadd(MINUTE, {start}, {midnight})"),
            "run_end": F.expr(f"timestampadd(MINUTE, {start} + {run_minutes}, {midnight})"),
        }
    )


def explode_counts(inspections: DataFrame) -> DataFrame:
    """Turn each header count into that many rows, numbered ``defect_seq`` from 1, with the header's other columns.

    Every count becomes ranges first, which are dealt to tasks and only then unfolded, so a header that
    stands for a large part of all defects does not become one task's work.
    """
    kept = [name for name in inspections.columns if name != "defect_count"]
    count = F.col("defect_count").cast("long")
    ranges = (
        inspections.filter(count > 0)
        .withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), count, F.lit(RANGE_ROWS).cast("long"))))
        .repartition("inspection_id", "first")
    )
    last = F.least(count, F.col("first") + (RANGE_ROWS - 1))
    return ranges.select(*kept, F.explode(F.sequence(F.col("first"), last)).alias("defect_seq"))


def radial_zone(sites: DataFrame, side: int = GRID_SIDE) -> DataFrame:
    """Add ``dist_sq``, the squared distance of (die_x, die_y) from the centre of a grid from 1 to ``side``, and ``zone``:
    center, mid or edge."""
    # Offsets from the centre are halves and their squares quarters, both exact as doubles.
    across, down = F.col("die_x") - (side + 1) / 2, F.col("die_y") - (side + 1) / 2
    far = F.col("dist_sq")
    zone = F.when(far > EDGE_ZONE_BEYOND, "edge").when(far > MID_ZONE_BEYOND, "mid").otherwise("center")
    return sites.withColumn("dist_sq", across * across + down * down).withColumn("zone", zone)


@dataclass(frozen=True)
class Metric:
    """One metric read on the runs that satisfy ``applies``."""

    metric_type: str
    applies: Column
    value: Column
    target: Column
    spec_low: Column
    spec_high: Column
    unit: str


def metrology_long(runs: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """One row per run and metric read on it, in one pass over the runs.

    A run yields an array with an entry for each metric that applies, and the array is unfolded.
    """
    kind = "decimal(12,4)"

    def reading(metric: Metric) -> Column:
        return F.when(
            metric.applies,
            F.struct(
                F.lit(metric.metric_type).alias("metric_type"),
                metric.value.cast(kind).alias("value"),
                metric.target.cast(kind).alias("target"),
                metric.spec_low.cast(kind).alias("spec_low"),
                metric.spec_high.cast(kind).alias("spec_high"),
                F.lit(metric.unit).alias("unit"),
            ),
        )

    taken = F.array_compact(F.array(*[reading(metric) for metric in metrics]))
    return runs.select("process_run_id", F.col("run_start").alias("measured_at"), F.inline(taken)).select(
        "process_run_id", "metric_type", "value", "target", "spec_low", "spec_high", "unit", "measured_at"
    )
