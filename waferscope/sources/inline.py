"""Small literal tables as SQL ``VALUES``: Spark knows their exact size, so joins to them broadcast."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def inline_rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """``rows`` under a DDL ``schema`` such as ``"tool_id int, tool_code string"``."""
    fields = [field.strip().split(" ", 1) for field in schema.split(", ")]
    names = ", ".join(name for name, _ in fields)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")
