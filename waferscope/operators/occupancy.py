"""Can the runs have happened? A chamber takes one at a time.

A run overlaps an earlier one if it starts before the latest end so far. That running maximum is put together from parts, as a chamber
may have taken a large part of all runs: the latest end of each minute of starts, of each day, and the days in order. Runs are
ordered within their minute only, minutes within their day, and no two runs are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from waferscope.operators.cohort import Tables

_PLACE = ["tool_id", "chamber_id"]
_PARTS = ["tool_key", "chamber_key"]
_NONE = -1


def _before(column: str, by: list[str], order: list[str]) -> Column:
    """The greatest value of the rows before this one."""
    return F.max(column).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))


def run_sequence(tables: Tables) -> DataFrame:
    """``process_run_id, tool_id, chamber_id, run_start, run_end, busy_until``: every run with a start, and the latest end of the runs of its
    place before it, in order of start and id; null for the first.

    A place is a chamber, or a tool for runs that name no chamber. A run without an end, or with one before its start, takes no time.
    """
    runs = tables["process_runs"].filter("run_start IS NOT NULL").select(
        "process_run_id",
        *_PLACE,
        "run_start",
        F.greatest("run_start", F.coalesce("run_end", "run_start")).alias("run_end"),
        # A chamber is a place whatever tool its runs name; null keys would not meet.
        F.when(F.col("chamber_id").isNull(), F.coalesce("tool_id", F.lit(_NONE))).otherwise(_NONE).cast("long").alias("tool_key"),
        F.coalesce("chamber_id", F.lit(_NONE)).cast("long").alias("chamber_key"),
        F.to_date("run_start").alias("day"),
        F.date_trunc("minute", "run_start").alias("minute"),
    )
    minute, day = [*_PARTS, "day", "minute"], [*_PARTS, "day"]
    by_minute = runs.groupBy(*minute).agg(F.max("run_end").alias("top"))
    by_day = by_minute.groupBy(*day).agg(F.max("top").alias("top"))
    days = by_day.select(*day, _before("top", _PARTS, ["day"]).alias("earlier_days"))
    minutes = by_minute.join(days, day).select(
        *minute, F.greatest("earlier_days", _before("top", day, ["minute"])).alias("earlier_minutes")
    )
    busy = F.greatest("earlier_minutes", _before("run_end", minute, ["run_start", "process_run_id"]))
    return runs.join(minutes, minute).select("process_run_id", *_PLACE, "run_start", "run_end", busy.alias("busy_until"))


def _overlaps() -> Column:
    return F.coalesce(F.col("run_start") < F.col("busy_until"), F.lit(False))


def _named(tables: Tables, df: DataFrame) -> DataFrame:
    """df with the codes of its place: the chamber's own tool, or the run's where it names no chamber."""
    tools = tables["tools"].select("tool_id", "tool_code")
    chambers = tables["chambers"].select("chamber_id", F.col("tool_id").alias("own_tool"), "chamber_code")
    placed = df.join(chambers, "chamber_id", "left").withColumn("tool_id", F.coalesce("own_tool", "tool_id"))
    return placed.join(tools, "tool_id", "left")


def overlapping_runs(tables: Tables) -> DataFrame:
    """The runs that start before an earlier run of their place has ended, and until when the place was taken."""
    found = _named(tables, run_sequence(tables).filter(_overlaps()))
    return found.select("process_run_id", "tool_code", "chamber_code", "run_start", "busy_until")


def occupancy(tables: Tables) -> DataFrame:
    """Per place its runs, those that overlap an earlier one, and the seconds in which at least one ran, which overlaps count once.

    ``chamber_code`` is null for runs that name no chamber.
    """
    free = F.greatest("run_start", F.coalesce("busy_until", "run_start"))
    seconds = F.greatest(F.expr("timestampdiff(SECOND, free, run_end)"), F.lit(0).cast("long"))
    sequence = run_sequence(tables).withColumn("free", free)
    # The chamber's own tool names it, whatever tool its runs name.
    tool = F.when(F.col("chamber_id").isNull(), F.col("tool_id")).alias("tool_id")
    sums = sequence.groupBy("chamber_id", tool).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count(F.when(_overlaps(), F.lit(1))).alias("overlapping"),
        F.sum(seconds).alias("busy_seconds"),
    )
    return (
        _named(tables, sums)
        .select("tool_code", "chamber_code", "runs", "overlapping", "busy_seconds")
        .orderBy("tool_code", "chamber_code")
    )
