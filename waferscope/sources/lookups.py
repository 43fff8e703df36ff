"""Reference vocabularies.

Fixed values: codes, names, categories and flags below are the catalogue that results are compared
against, so they are stated as they are.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from waferscope.sources.inline import inline_rows

TOOLS = [
    ("LITHO-01", "Litho Scanner 1", "Scanner", "ASML", "NXE:3400", date(2021, 3, 15)),
    ("LITHO-02", "Litho Scanner 2", "Scanner", "ASML", "NXE:3400", date(2021, 6, 20)),
    ("ETCH-01", "Etcher 1", "Etcher", "Lam Research", "Kiyo", date(2020, 11, 1)),
    ("ETCH-02", "Etcher 2", "Etcher", "TEL", "Tactras", date(2021, 1, 10)),
    ("ETCH-03", "Etcher 3", "Etcher", "Applied Materials", "Centris", date(2021, 9, 5)),
    ("DEP-01", "Deposition 1", "Deposition", "Applied Materials", "Producer", date(2020, 8, 12)),
    ("DEP-02", "Deposition 2", "Deposition", "TEL", "Trias", date(2021, 2, 18)),
    ("CMP-01", "CMP 1", "CMP", "Applied Materials", "Reflexion", date(2020, 10, 22)),
    ("IMP-01", "Implanter 1", "Implant", "Applied Materials", "VIISta", date(2020, 7, 30)),
    ("CDSEM-01", "CD-SEM 1", "CD-SEM", "Hitachi", "CG6300", date(2021, 4, 1)),
    ("OVL-01", "Overlay Tool 1", "Metrology", "KLA", "Archer", date(2021, 4, 1)),
    ("INSP-01", "Inspector 1", "Inspection", "KLA", "2935", date(2021, 5, 14)),
    ("INSP-02", "Inspector 2", "Inspection", "Applied Materials", "SEMVision", date(2021, 7, 19)),
]

PROCESS_STEPS = [
    ("DEP-100", "STI Oxide Deposition", "Deposition", 10, "Shallow trench isolation fill"),
    ("CMP-100", "STI CMP", "CMP", 20, "Planarize STI oxide"),
    ("IMP-100", "Well Implant", "Implant", 30, "Well / channel doping"),
    ("LITHO-100", "Gate Litho Expose", "Lithography", 40, "Gate layer exposure"),
    ("ETCH-100", "Gate Etch", "Etch", 50, "Gate pattern etch"),
    ("LITHO-200", "Metal-1 Litho Expose", "Lithography", 60, "Metal-1 layer exposure"),
    ("ETCH-200", "Metal-1 Etch", "Etch", 70, "Metal-1 pattern etch"),
    ("DEP-200", "Metal-1 Deposition", "Deposition", 80, "Metal-1 fill"),
    ("CMP-200", "Metal-1 CMP", "CMP", 90, "Planarize metal-1"),
    ("METR-100", "CD / Overlay Metrology", "Metrology", 100, "Post-litho CD and overlay measure"),
]

DEFECT_TYPES = [
    ("PART", "Particle", "Particle", True, "Chamber contamination"),
    ("SCRATCH", "Scratch", "Mechanical", True, "Wafer handling / CMP"),
    ("BRIDGE", "Bridge", "Pattern", True, "Litho focus / etch profile"),
    ("OPEN", "Open", "Pattern", True, "Etch residue / underetch"),
    ("RESIDUE", "Residue", "Contamination", False, "Incomplete etch clean"),
    ("VOID", "Void", "Pattern", True, "Deposition void"),
    ("CONTAM", "Contamination", "Contamination", False, "Clean process excursion"),
    ("FLAKE", "Flake", "Particle", False, "Chamber wall flaking"),
]

BIN_CODES = [
    (1, "Pass", "Pass", True),
    (2, "Open", "Hard Fail", False),
    (3, "Short", "Hard Fail", False),
    (4, "Speed Fail", "Parametric Fail", False),
    (5, "Leakage", "Parametric Fail", False),
    (6, "IDDQ", "Parametric Fail", False),
    (7, "Gross Fail", "Hard Fail", False),
    (8, "Functional", "Hard Fail", False),
]

# Chambers per multi-chamber tool; every other tool runs without one.
CHAMBERS = [
    ("ETCH-01", "A"),
    ("ETCH-01", "B"),
    ("ETCH-01", "C"),
    ("ETCH-02", "A"),
    ("ETCH-02", "B"),
    ("ETCH-02", "C"),
    ("ETCH-03", "A"),
    ("ETCH-03", "B"),
    ("DEP-01", "A"),
    ("DEP-01", "B"),
    ("DEP-01", "C"),
    ("DEP-01", "D"),
    ("DEP-02", "A"),
    ("DEP-02", "B"),
]


def _numbered(rows: list[tuple]) -> list[tuple]:
    return [(number, *row) for number, row in enumerate(rows, start=1)]


def tools(spark: SparkSession) -> DataFrame:
    schema = (
        "tool_id int, tool_code string, tool_name string, tool_type string, "
        "manufacturer string, model string, install_date date, is_active boolean"
    )
    return inline_rows(spark, schema, [(*row, True) for row in _numbered(TOOLS)])


def process_steps(spark: SparkSession) -> DataFrame:
    schema = (
        "process_step_id int, step_code string, step_name string, process_module string, "
        "sequence_order int, description string"
    )
    return inline_rows(spark, schema, _numbered(PROCESS_STEPS))


def defect_types(spark: SparkSession) -> DataFrame:
    schema = (
        "defect_type_id int, defect_code string, defect_name string, category string, "
        "is_killer boolean, typical_root_cause string, description string"
    )
    return inline_rows(spark, schema, [(*row, None) for row in _numbered(DEFECT_TYPES)])


def bin_codes(spark: SparkSession) -> DataFrame:
    schema = (
        "bin_code_id int, bin_number int, bin_name string, bin_category string, "
        "is_pass boolean, description string"
    )
    return inline_rows(spark, schema, [(*row, None) for row in _numbered(BIN_CODES)])


def chamber_codes(spark: SparkSession) -> DataFrame:
    """Chambers named by their tool's code; ``operators.shaping.resolve_keys`` finds the tool id."""
    return inline_rows(spark, "chamber_id int, tool_code string, chamber_code string", _numbered(CHAMBERS))
