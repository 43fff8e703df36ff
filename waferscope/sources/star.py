"""Fab tables read from an order-management star schema.

An order stands for a wafer and 25 consecutive orders for a lot; its line items are the wafer's
process runs, tested dies and readings; a supplier is a chamber of the tool its nation names; events
are classified defects. Everything is integer arithmetic on the stored columns, so another engine can
derive the same rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waferscope.functions.decimals import READING
from waferscope.operators.shaping import derive_lots, lot_number
from waferscope.sources import lookups
from waferscope.sources.inline import inline_rows
from waferscope.sources.lazy import LazyTables

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}

WAFERS_PER_LOT = 25
RUN_MINUTES = 20
UNCHAMBERED_STEP = 2

STEP_MODULES = ["Deposition", "CMP", "Implant", "Lithography", "Etch", "Etch", "Metrology"]

EVENT_DEFECTS = [
    ("click", "Interaction", False),
    ("error", "Failure", True),
    ("purchase", "Transaction", False),
    ("signup", "Interaction", False),
    ("view", "Interaction", True),
]


def read_star(spark: SparkSession, folder: str) -> LazyTables:
    """The source tables, with their schemas stated so that no footer is read for inference."""
    return LazyTables(
        {
            name: lambda name=name: spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
            for name in SCHEMAS
        }
    )


def bind_star(spark: SparkSession, folder: str) -> LazyTables:
    """The fab tables over the star schema in ``folder``."""
    src = read_star(spark, folder)
    return LazyTables(
        {
            "tools": lambda: _tools(src),
            "process_steps": lambda: _process_steps(spark),
            "defect_types": lambda: _defect_types(spark),
            "bin_codes": lambda: lookups.bin_codes(spark),
            "lots": lambda: _lots(src),
            "wafers": lambda: _wafers(src),
            "chambers": lambda: _chambers(src),
            "process_runs": lambda: _process_runs(src),
            "defect_inspections": lambda: _inspections(src),
            "bin_results": lambda: _bin_results(src),
            "metrology_measurements": lambda: _metrology(src["lineitem"], src["events"], src),
            "metrology_readings": lambda: _readings(src),
            "defects": lambda: _defects(src),
        }
    )


def lot_numbers(orders: DataFrame) -> DataFrame:
    """One row per lot: its number ``n``."""
    return orders.select(F.expr(f"o_orderkey div {WAFERS_PER_LOT}").alias("n")).distinct()


def _tools(src: LazyTables) -> DataFrame:
    types = src["region"].select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("tool_type"))
    return (
        src["nation"]
        .join(types, "n_regionkey")
        .select(
            F.col("n_nationkey").alias("tool_id"),
            F.col("n_name").alias("tool_code"),
            F.col("n_name").alias("tool_name"),
            "tool_type",
            F.lit(True).alias("is_active"),
        )
    )


def _process_steps(spark: SparkSession) -> DataFrame:
    rows = [
        (number, f"STEP-{number}", f"{module} {number}", module, number * 10)
        for number, module in enumerate(STEP_MODULES, start=1)
    ]
    schema = (
        "process_step_id int, step_code string, step_name string, process_module string, sequence_order int"
    )
    return inline_rows(spark, schema, rows)


def _defect_types(spark: SparkSession) -> DataFrame:
    rows = [
        (number, name.upper(), name, category, killer)
        for number, (name, category, killer) in enumerate(EVENT_DEFECTS, start=1)
    ]
    schema = "defect_type_id int, defect_code string, defect_name string, category string, is_killer boolean"
    return inline_rows(spark, schema, rows)


def _lots(src: LazyTables) -> DataFrame:
    return derive_lots(lot_numbers(src["orders"]), node_stride=3).withColumnRenamed("n", "lot_id")


def _wafers(src: LazyTables) -> DataFrame:
    lot = F.expr(f"o_orderkey div {WAFERS_PER_LOT}")
    slot = (F.col("o_orderkey") % WAFERS_PER_LOT + 1).cast("int")
    return src["orders"].select(
        F.col("o_orderkey").alias("wafer_id"),
        F.concat(lot_number(lot), F.lit("."), F.lpad(slot.cast("string"), 2, "0")).alias("wafer_scribe"),
        lot.alias("lot_id"),
        slot.alias("slot_no"),
        F.lit("Good").alias("status"),
    )


def _chambers(src: LazyTables) -> DataFrame:
    return src["supplier"].select(
        F.col("s_suppkey").alias("chamber_id"),
        F.col("s_nationkey").alias("tool_id"),
        F.col("s_name").alias("chamber_code"),
        F.col("s_name").alias("chamber_name"),
        F.lit(True).alias("is_active"),
    )


def _line_id() -> Column:
    """The natural key of a line item as text; a few lines share one."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _chamber_of_line() -> Column:
    return F.when(F.col("l_linenumber") != UNCHAMBERED_STEP, F.col("l_suppkey"))


def _lines_with_tool(src: LazyTables) -> DataFrame:
    # An outer join to a unique key: Catalyst drops it where a distinct needs no tool.
    tool = src["supplier"].select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("tool_id"))
    return src["lineitem"].join(tool, "l_suppkey", "left")


def _process_runs(src: LazyTables) -> DataFrame:
    return _lines_with_tool(src).select(
        _line_id().alias("process_run_id"),
        F.col("l_orderkey").alias("wafer_id"),
        F.col("l_linenumber").alias("process_step_id"),
        "tool_id",
        _chamber_of_line().alias("chamber_id"),
        F.col("l_shipdate").alias("run_start"),
        F.expr(f"timestampadd(MINUTE, {RUN_MINUTES}, l_shipdate)").alias("run_end"),
        F.lit("Completed").alias("run_status"),
    )


def _bin_results(src: LazyTables) -> DataFrame:
    fail_bin = F.lit(2) + (F.col("l_quantity").cast("long") % 7).cast("int")
    return src["lineitem"].select(
        _line_id().alias("bin_result_id"),
        F.col("l_orderkey").alias("wafer_id"),
        F.when(F.col("l_returnflag") != "R", F.lit(1)).otherwise(fail_bin).alias("bin_code_id"),
        F.col("l_linenumber").alias("die_x"),
        F.col("l_partkey").alias("die_y"),
    )


def _readings(src: LazyTables) -> DataFrame:
    """Readings with the tool of their run: the run's natural key is not quite unique, so joining
    readings back to runs could multiply rows."""
    events = src["events"].withColumn("tool_id", (F.col("event_id") % 25).cast("int"))
    return _metrology(_lines_with_tool(src), events, src, "tool_id")


def _metrology(lines: DataFrame, events: DataFrame, src: LazyTables, *extra: str) -> DataFrame:
    """One reading per line item, its metric set by the line number, plus one per event."""
    turn = F.col("l_linenumber") % 3
    per_line = lines.select(
        F.concat(F.lit("L"), _line_id()).alias("measurement_id"),
        _line_id().alias("process_run_id"),
        F.when(turn == 0, "CD").when(turn == 1, "Overlay").otherwise("Film Thickness").alias("metric_type"),
        F.when(turn == 0, F.col("l_quantity"))
        .when(turn == 1, F.col("l_discount") * 100 - 5)
        .otherwise(F.col("l_extendedprice"))
        .cast(READING)
        .alias("value"),
        F.when(turn == 0, F.lit(Decimal("25"))).when(turn == 1, F.lit(Decimal("0"))).cast(READING).alias("target"),
        F.when(turn == 0, F.lit(Decimal("1"))).when(turn == 1, F.lit(Decimal("-5"))).cast(READING).alias("spec_low"),
        F.when(turn == 0, F.lit(Decimal("50"))).when(turn == 1, F.lit(Decimal("5"))).cast(READING).alias("spec_high"),
        F.when(turn == 2, "A").otherwise("nm").alias("unit"),
        F.col("l_shipdate").alias("measured_at"),
        F.col("l_orderkey").alias("wafer_id"),
        *extra,
    )
    missing = F.lit(None)
    per_event = events.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("measurement_id"),
        missing.cast("string").alias("process_run_id"),
        F.lit("Sheet Resistance").alias("metric_type"),
        F.col("value").cast(READING).alias("value"),
        missing.cast(READING).alias("target"),
        missing.cast(READING).alias("spec_low"),
        missing.cast(READING).alias("spec_high"),
        F.lit("ohm/sq").alias("unit"),
        F.col("ts").alias("measured_at"),
        _wafer_of_event(src).alias("wafer_id"),
        *extra,
    )
    return per_line.unionByName(per_event)


def _wafer_of_event(src: LazyTables) -> Column:
    """Events of even ids fall on all wafers alike, the others on every eighth, which thus carry many defects.

    NULL without wafers.
    """
    count = src["orders"].agg(F.count(F.lit(1)).alias("wafers"))
    wafers = count.select(F.nullif("wafers", F.lit(0))).scalar()
    eighths = F.shiftright(wafers + 7, 3)
    number = F.col("event_id") * 37 + F.col("user_id")
    return F.when(F.col("event_id") % 2 == 0, number % wafers).otherwise(number % eighths * 8)


def _defects(src: LazyTables) -> DataFrame:
    type_id = F.lit(None).cast("int")
    for number, (name, _, _) in reversed(list(enumerate(EVENT_DEFECTS, start=1))):
        type_id = F.when(F.col("event_type") == name, F.lit(number)).otherwise(type_id)
    return src["events"].select(
        F.col("event_id").alias("defect_id"),
        _wafer_of_event(src).alias("inspection_id"),
        type_id.alias("defect_type_id"),
        (F.col("event_id") * 7919 % 150_000 - 75_000).cast(READING).alias("x_um"),
        (F.col("event_id") * 104_729 % 150_000 - 75_000).cast(READING).alias("y_um"),
        (F.col("value").cast("decimal(12,4)") / 100).cast("decimal(10,4)").alias("defect_size_um"),
    )


def _inspections(src: LazyTables) -> DataFrame:
    """One inspection per wafer that has events; its header states how many."""
    return (
        src["events"]
        .groupBy(_wafer_of_event(src).alias("wafer_id"))
        .agg(F.count(F.lit(1)).alias("defect_count"), F.min("ts").alias("inspection_date"))
        .select(
            F.col("wafer_id").alias("inspection_id"),
            "wafer_id",
            (F.col("wafer_id") % 25).cast("int").alias("tool_id"),
            "inspection_date",
            F.lit("Post-Etch (Metal-1)").alias("inspection_step"),
            F.col("defect_count").cast("long").alias("defect_count"),
        )
    )
