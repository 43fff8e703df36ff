"""Exact decimal measures. Percentages and means are rounded HALF_UP, once, where they are defined."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

PERCENT = "decimal(5,2)"
READING = "decimal(12,4)"
# Means of counts and of readings are not percentages: they may be as large as what is counted.
MEAN_COUNT = "decimal(12,2)"
MEAN_READING = "decimal(12,3)"


def pct(part: Column, total: Column) -> Column:
    """``100 * part / total`` as decimal(5,2); a zero total is an error."""
    return (F.lit(Decimal("100.0")) * part / total).cast(PERCENT)


def pct_or_null(part: Column, total: Column) -> Column:
    """``pct`` that yields NULL on a zero total."""
    return pct(part, F.nullif(total, F.lit(0)))


def count_if(condition: Column) -> Column:
    """Rows for which the condition is true; 0, not NULL, when there are none."""
    return F.count(F.when(condition, F.lit(1)))


def mean_of_sums(total: Column, rows: Column, scale: int) -> Column:
    """The mean a plain ``avg`` over the rows would give: four digits more than the summed values."""
    return (total / rows).cast(f"decimal(38,{scale + 4})")
