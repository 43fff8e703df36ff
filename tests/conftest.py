"""One session for all tests, and a builder of small fab tables."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from waferscope.session import local_session  # noqa: E402
from waferscope.sources.contract import TABLES  # noqa: E402

START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star_folder() -> str:
    return "/root/testdata/sf0.001"


# Values a test does not care about.
FILLER = {
    "tools": {"tool_name": "t", "tool_type": "Etcher", "is_active": True},
    "process_steps": {"step_name": "s", "process_module": "Etch"},
    "defect_types": {"category": "c", "is_killer": False},
    "bin_codes": {"bin_name": "b", "bin_category": "c"},
    "lots": {"product": "P", "technology_node": "N", "planned_qty": 25, "status": "Completed"},
    "wafers": {"lot_id": 1, "slot_no": 1, "status": "Good"},
    "chambers": {"is_active": True},
    "process_runs": {"process_step_id": 1, "run_start": START, "run_status": "Completed"},
    "defect_inspections": {"tool_id": 1, "inspection_date": START, "defect_count": 0},
    "bin_results": {},
    "metrology_measurements": {"metric_type": "CD"},
    "defects": {},
}


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    """Rows given by the columns that matter; the rest are fillers or NULL. Keys default to 1, 2, .."""
    spec = TABLES[name]
    columns = [f.name for f in spec.fields]
    ddl = ", ".join(f"{f.name} {f.kind}" for f in spec.fields)
    full = [{spec.key: number, **FILLER[name], **row} for number, row in enumerate(rows, start=1)]
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in full], ddl)


@pytest.fixture
def fab(spark) -> Callable[..., dict[str, DataFrame]]:
    """Builds all twelve tables from lists of partial rows; unnamed tables get small defaults."""
    basics = {
        "tools": [
            {"tool_code": "E1"},
            {"tool_code": "E2"},
            {"tool_code": "D1", "tool_type": "Deposition"},
        ],
        "chambers": [
            {"tool_id": 1, "chamber_code": "A"},
            {"tool_id": 1, "chamber_code": "B"},
            {"tool_id": 2, "chamber_code": "A"},
            {"tool_id": 3, "chamber_code": "A"},
        ],
        "process_steps": [{"step_code": "S1", "sequence_order": 10}, {"step_code": "S2", "sequence_order": 20}],
        "defect_types": [
            {"defect_code": "PART", "defect_name": "Particle"},
            {"defect_code": "FLAKE", "defect_name": "Flake"},
            {"defect_code": "VOID", "defect_name": "Void"},
        ],
        "bin_codes": [{"bin_number": 1, "is_pass": True}, {"bin_number": 2, "is_pass": False}],
        "lots": [{"lot_number": "L1"}],
    }

    def build(**rows: list[dict]) -> dict[str, DataFrame]:
        return {name: table(spark, name, rows.get(name, basics.get(name, []))) for name in TABLES}

    return build


def wafers(*ids: int, lot: int = 1) -> list[dict]:
    return [{"wafer_id": i, "wafer_scribe": f"W{i}", "lot_id": lot, "slot_no": (i - 1) % 25 + 1} for i in ids]


def dies(wafer: int, passed: int, failed: int) -> list[dict]:
    """Dies of one wafer in a row of the grid."""
    return [
        {"bin_result_id": wafer * 1000 + x, "wafer_id": wafer, "bin_code_id": 1 if x < passed else 2, "die_x": x, "die_y": 1}
        for x in range(passed + failed)
    ]


def run(wafer: int, tool: int, chamber: int | None, step: int = 1) -> dict:
    return {"wafer_id": wafer, "tool_id": tool, "chamber_id": chamber, "process_step_id": step}


def rows(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
