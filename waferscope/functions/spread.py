"""Sample standard deviation from sums that partial aggregates can carry.

Yields are bounded two-digit decimals, so their sums of squares stay exact in decimal arithmetic and
the spread over any grouping can be merged from per-key sums without rereading the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact_square(value: Column) -> Column:
    return (value * value).cast("decimal(11,4)")


def sigma_of_sums(rows: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation as double; NULL for fewer than two rows.

    The types hold 10^13 rows of a percentage; beyond, the casts fail rather than give a wrong spread.
    """
    count = rows.cast("decimal(15,0)")
    about_mean = count * squares.cast("decimal(21,4)") - total.cast("decimal(17,2)") * total.cast("decimal(17,2)")
    pairs = rows.cast("double") * (rows - 1)
    return F.sqrt(about_mean.cast("double") / F.nullif(pairs, F.lit(0.0)))


def square(value: Column) -> Column:
    """The square of a reading, as a decimal that sums hold exactly."""
    return (value * value).cast("decimal(24,8)")


def sigma_of_reading_sums(rows: Column, total: Column, squares: Column) -> Column:
    """``sigma_of_sums`` for readings of four digits: the sum of squares about the mean is exact to six digits."""
    about_mean = squares.cast("decimal(38,8)") - (total * (total / rows)).cast("decimal(38,8)")
    return F.sqrt(F.greatest(about_mean.cast("double"), F.lit(0.0)) / F.nullif(rows - 1, F.lit(0)))
