"""The twelve fab tables: columns, keys, links, value rules and defaults, as data.

Tables are listed parents first. Nothing here is enforced on insert; ``plans.audits`` reports
violations and ``operators.shaping.apply_defaults`` fills defaults at load.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool = False
    max_length: int | None = None
    default: object = None


@dataclass(frozen=True)
class Link:
    column: str
    parent: str


@dataclass(frozen=True)
class Rule:
    """A value rule. NULL counts as a pass, as it does for a SQL CHECK."""

    name: str
    holds: str


@dataclass(frozen=True)
class Table:
    name: str
    key: str
    fields: tuple[Field, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    links: tuple[Link, ...] = ()
    rules: tuple[Rule, ...] = field(default=())

    def ddl(self) -> str:
        """The schema as DDL text, as ``spark.read.schema`` takes it."""
        return ", ".join(f"{f.name} {f.kind}{' NOT NULL' if f.required else ''}" for f in self.fields)


def _text(name: str, length: int, required: bool = False, default: str | None = None) -> Field:
    return Field(name, "string", required, length, default)


def _int(name: str, required: bool = True, default: int | None = None) -> Field:
    # Keys and counts are 64-bit: the row counts this is written for exceed 32 bits.
    return Field(name, "bigint", required, default=default)


def _number(name: str, required: bool = False, kind: str = "decimal(12,4)") -> Field:
    return Field(name, kind, required)


def _flag(name: str, default: bool) -> Field:
    return Field(name, "boolean", True, default=default)


def _moment(name: str, required: bool = False) -> Field:
    return Field(name, "timestamp_ntz", required)


_ALL = (
    Table(
        "tools",
        "tool_id",
        (
            _int("tool_id"),
            _text("tool_code", 20, True),
            _text("tool_name", 100),
            _text("tool_type", 50, True),
            _text("manufacturer", 50),
            _text("model", 50),
            Field("install_date", "date"),
            _flag("is_active", True),
        ),
        unique=(("tool_code",),),
    ),
    Table(
        "process_steps",
        "process_step_id",
        (
            _int("process_step_id"),
            _text("step_code", 20, True),
            _text("step_name", 100, True),
            _text("process_module", 50, True),
            _int("sequence_order", False),
            _text("description", 255),
        ),
        unique=(("step_code",),),
    ),
    Table(
        "defect_types",
        "defect_type_id",
        (
            _int("defect_type_id"),
            _text("defect_code", 20, True),
            _text("defect_name", 100, True),
            _text("category", 50, True),
            _flag("is_killer", False),
            _text("typical_root_cause", 255),
            _text("description", 255),
        ),
        unique=(("defect_code",),),
    ),
    Table(
        "bin_codes",
        "bin_code_id",
        (
            _int("bin_code_id"),
            _int("bin_number"),
            _text("bin_name", 100, True),
            _text("bin_category", 50, True),
            _flag("is_pass", False),
            _text("description", 255),
        ),
        unique=(("bin_number",),),
    ),
    Table(
        "lots",
        "lot_id",
        (
            _int("lot_id"),
            _text("lot_number", 20, True),
            _text("product", 50, True),
            _text("technology_node", 20, True),
            _int("planned_qty", default=25),
            Field("start_date", "date"),
            _text("status", 20, True, "In Process"),
        ),
        unique=(("lot_number",),),
    ),
    Table(
        "wafers",
        "wafer_id",
        (
            _int("wafer_id"),
            _text("wafer_scribe", 30, True),
            _int("lot_id"),
            _int("slot_no"),
            _text("status", 20, True, "Good"),
        ),
        unique=(("wafer_scribe",), ("lot_id", "slot_no")),
        links=(Link("lot_id", "lots"),),
        rules=(Rule("slot_in_cassette", "slot_no BETWEEN 1 AND 25"),),
    ),
    Table(
        "chambers",
        "chamber_id",
        (
            _int("chamber_id"),
            _int("tool_id"),
            _text("chamber_code", 10, True),
            _text("chamber_name", 100),
            _flag("is_active", True),
        ),
        unique=(("tool_id", "chamber_code"),),
        links=(Link("tool_id", "tools"),),
    ),
    Table(
        "process_runs",
        "process_run_id",
        (
            _int("process_run_id"),
            _int("wafer_id"),
            _int("process_step_id"),
            _int("tool_id"),
            _int("chamber_id", False),
            _moment("run_start", True),
            _moment("run_end"),
            _text("run_status", 20, True, "Completed"),
        ),
        links=(
            Link("wafer_id", "wafers"),
            Link("process_step_id", "process_steps"),
            Link("tool_id", "tools"),
            Link("chamber_id", "chambers"),
        ),
    ),
    Table(
        "defect_inspections",
        "inspection_id",
        (
            _int("inspection_id"),
            _int("wafer_id"),
            _int("tool_id"),
            _moment("inspection_date", True),
            _text("inspection_step", 50),
            _int("defect_count", default=0),
        ),
        links=(Link("wafer_id", "wafers"), Link("tool_id", "tools")),
        rules=(Rule("count_not_negative", "defect_count >= 0"),),
    ),
    Table(
        "bin_results",
        "bin_result_id",
        (
            _int("bin_result_id"),
            _int("wafer_id"),
            _int("bin_code_id"),
            _int("die_x"),
            _int("die_y"),
        ),
        unique=(("wafer_id", "die_x", "die_y"),),
        links=(Link("wafer_id", "wafers"), Link("bin_code_id", "bin_codes")),
    ),
    Table(
        "metrology_measurements",
        "measurement_id",
        (
            _int("measurement_id"),
            _int("process_run_id"),
            _text("metric_type", 30, True),
            _number("value", True),
            _number("target"),
            _number("spec_low"),
            _number("spec_high"),
            _text("unit", 15),
            _moment("measured_at"),
        ),
        links=(Link("process_run_id", "process_runs"),),
        rules=(Rule("spec_limits_ordered", "spec_low <= spec_high"),),
    ),
    Table(
        "defects",
        "defect_id",
        (
            _int("defect_id"),
            _int("inspection_id"),
            _int("defect_type_id"),
            _number("x_um"),
            _number("y_um"),
            _number("defect_size_um", kind="decimal(10,4)"),
        ),
        links=(Link("inspection_id", "defect_inspections"), Link("defect_type_id", "defect_types")),
        rules=(Rule("size_not_negative", "defect_size_um >= 0"),),
    ),
)

TABLES: dict[str, Table] = {table.name: table for table in _ALL}


def default_columns(table: Table) -> dict[str, Column]:
    """Replacement expressions for the columns that have a default."""
    return {f.name: F.coalesce(F.col(f.name), F.lit(f.default)) for f in table.fields if f.default is not None}


def conform(df: DataFrame, name: str) -> DataFrame:
    """The table's columns, in contract order and type; missing optional columns become NULL."""
    present = set(df.columns)
    missing = [f.name for f in TABLES[name].fields if f.name not in present and f.required and f.default is None]
    if missing:
        raise ValueError(f"{name}: required columns missing: {', '.join(missing)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.kind).alias(f.name)
            for f in TABLES[name].fields
        ]
    )
