"""Shifts too small for a limit on single readings: cumulative sums along time.

A tool may have taken most of all readings, so its readings are never put in order in one task. A cumulative sum that starts anew
whenever it would fall below zero is the running total less the lowest running total so far, and both can be put together
from parts: of each minute the total and the lowest running total in it, of each day the same over its minutes, and the days
in order. Readings are then ordered within their minute only, minutes within their day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from waferscope.operators.cohort import Tables
from waferscope.operators.spc import beside_limits, metric_limits, readings

# Readings are counted in units of 1 / UNITS, in which half of a sigma of four digits is whole.
UNITS = 20_000
_SERIES = ["tool_id", "metric_type"]
_SIDES = ("high", "low")
_START = Window.unboundedPreceding


def _summed(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Parts put together: for each group its totals, and the lowest running total in it, from its start at 0."""
    ordered = Window.partitionBy(*by).orderBy(*order)
    running = df.withColumns({f"before_{s}": F.sum(f"total_{s}").over(ordered.rowsBetween(_START, -1)) for s in _SIDES})
    sums = [F.sum(f"total_{s}").alias(f"total_{s}") for s in _SIDES]
    lows = [F.min(F.coalesce(f"before_{s}", F.lit(0)) + F.col(f"lowest_{s}")).alias(f"lowest_{s}") for s in _SIDES]
    return running.groupBy(*by).agg(*sums, *lows)


def _carried(df: DataFrame, by: list[str], order: list[str], start: bool = False) -> DataFrame:
    """For each part the running total before it and the lowest one so far. With ``start`` both begin at 0; without, they are
    added to what the group they lie in was given as ``base`` and ``floor``."""
    ordered = Window.partitionBy(*by).orderBy(*order)
    made = df
    for s in _SIDES:
        base = F.lit(0).cast("long") if start else F.col(f"base_{s}")
        floor = F.lit(0).cast("long") if start else F.col(f"floor_{s}")
        before = F.coalesce(F.sum(f"total_{s}").over(ordered.rowsBetween(_START, -1)), F.lit(0))
        made = made.withColumn(f"own_{s}", base + before)
        lowest = F.min(F.col(f"own_{s}") + F.col(f"lowest_{s}")).over(ordered.rowsBetween(_START, -1))
        made = made.withColumn(f"least_{s}", F.least(floor, F.coalesce(lowest, floor)))
    return made.drop(*[f"{c}_{s}" for c in ("base", "floor") for s in _SIDES])


def _handed_down(df: DataFrame, keys: list[str]) -> DataFrame:
    """What _carried found for each part, under the names that its own parts take it up by."""
    return df.select(
        *keys, *[F.col(f"own_{s}").alias(f"base_{s}") for s in _SIDES], *[F.col(f"least_{s}").alias(f"floor_{s}") for s in _SIDES]
    )


def _sided(tables: Tables, slack: Column) -> DataFrame:
    """Readings with a time, and how far each lies beyond centre and slack on either side, in whole units."""
    measured = readings(tables, "tool_id").select("measurement_id", *_SERIES, "value", "measured_at").filter(
        "tool_id IS NOT NULL AND measured_at IS NOT NULL AND value IS NOT NULL"
    )
    limits = metric_limits(tables).select("metric_type", "center_line", F.col("sigma").alias("sg")).filter("sg IS NOT NULL")
    away = (F.col("value") - F.col("center_line")) * UNITS
    allowed = slack * UNITS
    return beside_limits(measured, limits).select(
        *_SERIES,
        "measured_at",
        "measurement_id",
        "value",
        F.to_date("measured_at").alias("day"),
        F.date_trunc("minute", "measured_at").alias("minute"),
        (away - allowed).cast("long").alias("total_high"),
        (-away - allowed).cast("long").alias("total_low"),
        (F.col("sg") * UNITS).cast("long").alias("sigma_units"),
    )


def cusum_points(tables: Tables) -> DataFrame:
    """Every reading's upper and lower cumulative sum, per tool and metric in order of time, id and value, in 1 / UNITS.

    The upper sum grows by what a reading exceeds its metric's centre line plus half a sigma and never falls below 0; the
    lower sum likewise below the centre line. Both go on through alarms. Readings without tool, time or value are left out, and metrics
    without a sigma. ``sigma_units`` is the metric's sigma.
    """
    points = _sided(tables, F.col("sg") / 2)
    minute, day = [*_SERIES, "day", "minute"], [*_SERIES, "day"]
    order = ["measured_at", "measurement_id", "value"]
    single = points.withColumns({f"lowest_{s}": F.col(f"total_{s}") for s in _SIDES})
    by_minute = _summed(single, minute, order)
    by_day = _summed(by_minute, day, ["minute"])
    days = _handed_down(_carried(by_day, _SERIES, ["day"], start=True), day)
    minutes = _handed_down(_carried(by_minute.join(days, day), day, ["minute"]), minute)
    found = _carried(single.join(minutes, minute), minute, order)
    made = found
    for s in _SIDES:
        here = F.col(f"own_{s}") + F.col(f"total_{s}")
        made = made.withColumn(f"sum_{s}", here - F.least(F.col(f"least_{s}"), here))
    return made.select("measurement_id", *_SERIES, "measured_at", "value", "sum_high", "sum_low", "sigma_units")


def cusum_by_tool(tables: Tables, alarm: int = 5) -> DataFrame:
    """Per tool and metric the readings whose cumulative sum exceeds ``alarm`` sigmas, the day of the first of them and the highest sum.

    It finds a lasting shift of about one sigma, which limits at three sigma on single readings hardly ever see.
    """
    points = cusum_points(tables)
    limit = F.col("sigma_units") * alarm
    aggregates = []
    for s in _SIDES:
        over = F.col(f"sum_{s}") > limit
        aggregates += [
            F.count(F.when(over, F.lit(1))).alias(f"alarms_{s}"),
            F.to_date(F.min(F.when(over, F.col("measured_at")))).alias(f"first_{s}"),
            (F.max(f"sum_{s}").cast("decimal(20,0)") / UNITS).cast("decimal(20,5)").alias(f"highest_{s}"),
        ]
    return (
        points.groupBy(*_SERIES)
        .agg(F.count(F.lit(1)).alias("readings"), *aggregates)
        .join(tables["tools"].select("tool_id", "tool_code"), "tool_id")
        .select("tool_code", "metric_type", "readings", *[f"{c}_{s}" for s in _SIDES for c in ("alarms", "first", "highest")])
        .orderBy("tool_code", "metric_type")
    )
