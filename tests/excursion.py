"""A labelled excursion: fab tables with one known bad chamber, for checking that analyses find it.

Every order of the source becomes a wafer. Work is dealt over the equipment in ``lookups``; wafers
through ETCH-02/C get more defects of other kinds, more failing dies and a CD shift. All draws are
integer mixing of the row's keys, so the same tables come out on every run and in any engine.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waferscope.operators import shaping
from waferscope.operators.cohort import Suspect, Tables, cohort_through, flag_cohort
from waferscope.sources import lookups
from waferscope.sources.lazy import LazyTables
from waferscope.sources.star import WAFERS_PER_LOT, read_star

# Percentage points of failing dies.
BASE_FAIL = 8
ZONE_FAIL = {"center": 0, "mid": 3, "edge": 6}
COHORT_FAIL = 6
PASS_BIN = 1
FIRST_FAIL_BIN = 2
FAIL_BINS = 7

# Upper bounds (exclusive) of a 0..99 roll and the defect code each range gives.
PLAIN_PROFILE = [
    (20, "PART"),
    (38, "BRIDGE"),
    (54, "OPEN"),
    (68, "RESIDUE"),
    (80, "VOID"),
    (90, "CONTAM"),
    (96, "SCRATCH"),
    (100, "FLAKE"),
]
COHORT_PROFILE = [(45, "PART"), (70, "FLAKE"), (82, "BRIDGE"), (91, "RESIDUE"), (100, "SCRATCH")]

# The mixing constants every consumer of these draws has to agree on.
MODULUS = 1_000_003
FACTORS = (7_919, 104_729, 1_299_709, 15_485_863)
LINEAR = 12_345


def draw(bound: int, *keys: Column | int) -> Column:
    """A whole number in ``0 .. bound-1`` that depends only on up to four integer keys."""
    terms = [
        (key.cast("long") if isinstance(key, Column) else F.lit(key).cast("long")) * factor
        for key, factor in zip(keys, FACTORS, strict=False)
    ]
    seed = reduce(lambda a, b: a + b, terms) % MODULUS
    return ((seed * seed + seed * LINEAR) % MODULUS % bound).cast("int")


def inspection_header(
    tables: Tables,
    cohort: DataFrame,
    tool_code: str,
    base: Column,
    boost: Column,
    step: str = "Post-Etch (Metal-1)",
    days_after_start: int = 3,
) -> DataFrame:
    """One inspection per wafer: ``base`` defects, plus ``boost`` for wafers in the cohort."""
    tool = tables["tools"].filter(F.col("tool_code") == tool_code).select("tool_id").scalar()
    lots = tables["lots"].select("lot_id", "start_date")
    wafers = tables["wafers"].select("wafer_id", "lot_id").join(lots, "lot_id")
    date = F.expr(f"timestampadd(DAY, {days_after_start}, CAST(start_date AS timestamp_ntz))")
    return flag_cohort(wafers, cohort).select(
        "wafer_id",
        tool.alias("tool_id"),
        date.alias("inspection_date"),
        F.lit(step).alias("inspection_step"),
        (base + F.when(F.col("in_cohort"), boost).otherwise(0)).cast("long").alias("defect_count"),
    )


def _by_roll(roll: Column, profile: Sequence[tuple[int, str]]) -> Column:
    choice = F.lit(profile[-1][1])
    for upper, code in reversed(profile[:-1]):
        choice = F.when(roll < upper, code).otherwise(choice)
    return choice


def weighted_category(
    rolls: DataFrame,
    plain: Sequence[tuple[int, str]] = PLAIN_PROFILE,
    cohort: Sequence[tuple[int, str]] = COHORT_PROFILE,
) -> DataFrame:
    """Add ``defect_code``: the range of the flag's profile that ``roll`` (0..99) falls in."""
    roll = F.col("roll")
    return rolls.withColumn(
        "defect_code", F.when(F.col("is_bad"), _by_roll(roll, cohort)).otherwise(_by_roll(roll, plain))
    )


def die_grid(wafers: DataFrame, side: int = shaping.GRID_SIDE) -> DataFrame:
    """Every site of every wafer.

    Wafers are placed by id before they multiply, so that work per wafer downstream needs no shuffle of dies.
    """
    axis = F.sequence(F.lit(1), F.lit(side))
    return wafers.repartition("wafer_id").withColumn("die_x", F.explode(axis)).withColumn("die_y", F.explode(axis))


def bin_assign(zoned: DataFrame) -> DataFrame:
    """Add ``bin_number`` from ``roll`` (0..99), ``zone`` and ``is_bad``.

    A die passes at or above its threshold; below it, the roll also picks the fail bin.
    """
    zone_points = F.lit(0)
    for zone, points in ZONE_FAIL.items():
        zone_points = F.when(F.col("zone") == zone, points).otherwise(zone_points)
    threshold = F.lit(BASE_FAIL) + zone_points + F.when(F.col("is_bad"), COHORT_FAIL).otherwise(0)
    fail_bin = F.col("roll") % FAIL_BINS + FIRST_FAIL_BIN
    return zoned.withColumn("bin_number", F.when(F.col("roll") >= threshold, PASS_BIN).otherwise(fail_bin))


BAD_TOOL, BAD_CHAMBER = "ETCH-02", "C"

MODULES = [
    shaping.ModuleTools("Lithography", ("Scanner",)),
    shaping.ModuleTools("Etch", ("Etcher",), by_chamber=True),
    shaping.ModuleTools("Deposition", ("Deposition",), by_chamber=True),
    shaping.ModuleTools("CMP", ("CMP",)),
    shaping.ModuleTools("Implant", ("Implant",)),
    shaping.ModuleTools("Metrology", ("Metrology", "CD-SEM")),
]

# Index of each draw, so that no two use the same mixture.
ROLL_BIN, ROLL_BASE, ROLL_BOOST, ROLL_TYPE, ROLL_X, ROLL_Y, ROLL_SIZE = 1, 2, 3, 4, 5, 6, 7
ROLL_CD, ROLL_OVERLAY, ROLL_FILM = (8, 9), (10, 11), (12, 13)


def known_suspect() -> Suspect:
    return Suspect.named(BAD_TOOL, BAD_CHAMBER)


def bind_excursion(spark: SparkSession, folder: str, independent_modules: bool = False) -> LazyTables:
    """The twelve tables over the orders in ``folder``.

    Dealing every module by wafer id makes counts that share a factor move together, so whole modules
    follow the bad chamber. With ``independent_modules`` the other modules are dealt by
    ``wafer_id div 8``, which is unrelated to the etch deal.
    """
    src = read_star(spark, folder)
    tables = LazyTables(
        {
            "tools": lambda: lookups.tools(spark),
            "process_steps": lambda: lookups.process_steps(spark),
            "defect_types": lambda: lookups.defect_types(spark),
            "bin_codes": lambda: lookups.bin_codes(spark),
            "lots": lambda: _lots(src),
            "wafers": lambda: wafers(src["orders"]),
            "chambers": lambda: _chambers(spark, tables),
            "process_runs": lambda: _process_runs(tables, independent_modules),
            "defect_inspections": lambda: _inspections(tables),
            "bin_results": lambda: _bin_results(tables),
            "metrology_measurements": lambda: _metrology(tables),
            "defects": lambda: _defects(tables),
        }
    )
    return tables


def wafers(orders: DataFrame) -> DataFrame:
    """Wafer ids from 1, 25 to a lot, lots from 1."""
    slot = (F.col("o_orderkey") % WAFERS_PER_LOT + 1).cast("int")
    lot = F.expr(f"o_orderkey div {WAFERS_PER_LOT}") + 1
    return orders.select(
        (F.col("o_orderkey") + 1).alias("wafer_id"),
        F.concat(shaping.lot_number(lot), F.lit("."), F.lpad(slot.cast("string"), 2, "0")).alias("wafer_scribe"),
        lot.alias("lot_id"),
        slot.alias("slot_no"),
        F.lit("Good").alias("status"),
    )


def _lots(src: LazyTables) -> DataFrame:
    numbers = src["orders"].select((F.expr(f"o_orderkey div {WAFERS_PER_LOT}") + 1).alias("n")).distinct()
    return shaping.derive_lots(numbers).withColumnRenamed("n", "lot_id")


def _chambers(spark: SparkSession, tables: LazyTables) -> DataFrame:
    tools = tables["tools"].select("tool_code", "tool_id", "tool_name")
    resolved = shaping.resolve_keys(lookups.chamber_codes(spark), tools, "tool_code", "tool_id")
    named = resolved.join(tools.select("tool_id", "tool_name"), "tool_id")
    return named.select(
        "chamber_id",
        "tool_id",
        "chamber_code",
        F.concat("tool_name", F.lit(" Ch "), "chamber_code").alias("chamber_name"),
        F.lit(True).alias("is_active"),
    )


def _process_runs(tables: LazyTables, independent_modules: bool) -> DataFrame:
    turn = F.col("wafer_id")
    if independent_modules:
        turn = F.when(F.col("process_module") == "Etch", turn).otherwise(F.expr("wafer_id div 8"))
    catalog = shaping.assignment_catalog(tables, MODULES)
    dealt = shaping.round_robin_assign(shaping.expand_route(tables, catalog), catalog, turn)
    steps = len(lookups.PROCESS_STEPS)
    return shaping.route_schedule(dealt).select(
        ((F.col("wafer_id") - 1) * steps + F.col("process_step_id")).alias("process_run_id"),
        "wafer_id",
        "process_step_id",
        "tool_id",
        "chamber_id",
        "run_start",
        "run_end",
        F.lit("Completed").alias("run_status"),
    )


def _cohort(tables: LazyTables) -> DataFrame:
    return cohort_through(tables, known_suspect())


def _bin_results(tables: LazyTables) -> DataFrame:
    flagged = flag_cohort(tables["wafers"].select("wafer_id"), _cohort(tables), "is_bad")
    rolled = die_grid(flagged).withColumn(
        "roll", draw(100, F.col("wafer_id"), F.col("die_x"), F.col("die_y"), ROLL_BIN)
    )
    binned = bin_assign(shaping.radial_zone(rolled))
    side = shaping.GRID_SIDE
    number = (F.col("wafer_id") - 1) * (side * side) + (F.col("die_x") - 1) * side + F.col("die_y")
    codes = tables["bin_codes"].select("bin_number", "bin_code_id")
    return shaping.resolve_keys(binned, codes, "bin_number", "bin_code_id").select(
        number.alias("bin_result_id"), "wafer_id", "bin_code_id", "die_x", "die_y"
    )


def _inspections(tables: LazyTables) -> DataFrame:
    wafer = F.col("wafer_id")
    headers = inspection_header(
        tables,
        _cohort(tables),
        tool_code="INSP-01",
        base=draw(5, wafer, 0, 0, ROLL_BASE) + 2,
        boost=draw(3, wafer, 0, 0, ROLL_BOOST) + 1,
    )
    return headers.select(wafer.alias("inspection_id"), "*")


def _defects(tables: LazyTables) -> DataFrame:
    headers = tables["defect_inspections"].select("inspection_id", "wafer_id", "defect_count")
    keys = (F.col("inspection_id"), F.col("defect_seq"), 0)
    flagged = flag_cohort(headers, _cohort(tables), "is_bad")
    rolled = shaping.explode_counts(flagged).withColumn("roll", draw(100, *keys, ROLL_TYPE))
    coded = weighted_category(rolled)
    types = tables["defect_types"].select("defect_code", "defect_type_id")
    return shaping.resolve_keys(coded, types, "defect_code", "defect_type_id").select(
        (F.col("inspection_id") * 100 + F.col("defect_seq")).alias("defect_id"),
        "inspection_id",
        "defect_type_id",
        (draw(150_000, *keys, ROLL_X) - 75_000).cast("decimal(12,4)").alias("x_um"),
        (draw(150_000, *keys, ROLL_Y) - 75_000).cast("decimal(12,4)").alias("y_um"),
        ((draw(200, *keys, ROLL_SIZE) + 5) / F.lit(Decimal("100"))).cast("decimal(10,4)").alias("defect_size_um"),
    )


def _two_draws(steps: int, center: str, run: Column, rolls: tuple[int, int]) -> Column:
    """The centre plus two tenths-of-a-unit draws of 0 .. steps, less their mean: a bell-leaning spread."""
    first, second = (draw(steps + 1, run, 0, 0, roll) for roll in rolls)
    return F.lit(Decimal(center)) + (first + second - steps) / F.lit(Decimal("10"))


def _constant(text: str) -> Column:
    return F.lit(Decimal(text))


def _metrology(tables: LazyTables) -> DataFrame:
    steps = tables["process_steps"].select("process_step_id", "step_code", "process_module")
    runs = tables["process_runs"].select("process_run_id", "wafer_id", "process_step_id", "run_start")
    flagged = flag_cohort(runs.join(steps, "process_step_id"), _cohort(tables), "is_bad")
    run = F.col("process_run_id")
    measured, deposited = F.col("step_code") == "METR-100", F.col("process_module") == "Deposition"
    shift = F.when(F.col("is_bad"), _constant("1.0")).otherwise(_constant("0.0"))
    # Targets and specification limits.
    metrics = [
        shaping.Metric(
            "CD",
            measured,
            _two_draws(30, "45.0", run, ROLL_CD) + shift,
            _constant("45.0"),
            _constant("42.0"),
            _constant("48.0"),
            "nm",
        ),
        shaping.Metric(
            "Overlay",
            measured,
            _two_draws(60, "0.0", run, ROLL_OVERLAY),
            _constant("0.0"),
            _constant("-10.0"),
            _constant("10.0"),
            "nm",
        ),
        shaping.Metric(
            "Film Thickness",
            deposited,
            _two_draws(300, "1000.0", run, ROLL_FILM),
            _constant("1000.0"),
            _constant("950.0"),
            _constant("1050.0"),
            "A",
        ),
    ]
    number = run * 2 + F.when(F.col("metric_type") == "Overlay", 1).otherwise(0)
    return shaping.metrology_long(flagged, metrics).select(number.alias("measurement_id"), "*")
