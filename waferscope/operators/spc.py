"""Control limits and mean shifts of metrology readings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from waferscope.functions.decimals import READING, count_if, mean_of_sums, pct
from waferscope.functions.labels import OTHERS
from waferscope.functions.spread import sigma_of_reading_sums, square
from waferscope.operators.cohort import Suspect, Tables, cohort_through, flag_cohort


def readings(tables: Tables, *run_columns: str) -> DataFrame:
    """Readings with the named columns of their run.

    Readings that carry the columns are used as they are, then those of an optional
    ``metrology_readings`` table, which sources without a unique run key provide; otherwise the run
    is looked up.
    """
    measured = tables["metrology_measurements"]
    if set(run_columns) <= set(measured.columns):
        return measured
    if "metrology_readings" in tables:
        found = tables["metrology_readings"]
        missing = [c for c in run_columns if c not in found.columns]
        if missing:
            raise ValueError(f"metrology_readings: columns missing: {', '.join(missing)}")
        return found
    return measured.join(tables["process_runs"].select("process_run_id", *run_columns), "process_run_id")


def _center() -> Column:
    return F.avg("value").cast(READING).alias("center_line")


def _sigma() -> Column:
    return F.stddev_samp("value").cast(READING).alias("sigma")


def _upper(center: Column, sigma: Column) -> Column:
    return (center + sigma * 3).cast(READING)


def _lower(center: Column, sigma: Column) -> Column:
    return (center - sigma * 3).cast(READING)


def beside_limits(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Readings beside their metric's limits, which are sent to all tasks, a row per metric.

    Were readings moved to meet them, a task would read all readings of a metric, and what follows by tool or time within the metric
    would stay in that task, however large.
    """
    return measured.join(F.broadcast(limits), "metric_type")


def spc_limits(tables: Tables) -> DataFrame:
    """Centre, sigma, three-sigma limits and readings beyond them, per metric.

    Centre and sigma are rounded before the limits and the comparison use them.
    """
    measured = tables["metrology_measurements"].select("metric_type", "value")
    stats = (
        measured.groupBy("metric_type")
        .agg(F.count(F.lit(1)).alias("readings"), _center(), _sigma())
        .withColumn("ucl", _upper(F.col("center_line"), F.col("sigma")))
        .withColumn("lcl", _lower(F.col("center_line"), F.col("sigma")))
    )
    beyond = (F.col("value") > F.col("ucl")) | (F.col("value") < F.col("lcl"))
    keys = ["metric_type", "readings", "center_line", "sigma", "ucl", "lcl"]
    return (
        beside_limits(measured, stats)
        .groupBy(*keys)
        .agg(count_if(beyond).alias("points_out_of_control"))
        .orderBy("metric_type")
    )


def _sums_by_wafer(chosen: DataFrame) -> DataFrame:
    return chosen.groupBy("wafer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.sum(square(F.col("value"))).alias("squares")
    )


def spc_group_shift(tables: Tables, suspect: Suspect, metric: str = "CD") -> DataFrame:
    """Mean of the suspect's wafers and of all others against the overall centre, in sigma units.

    Overall centre and sigma are used unrounded here. Readings are read once and summed per wafer, with their
    squares; groups and overall figures are merged from those sums.
    """
    per_wafer = _sums_by_wafer(readings(tables, "wafer_id").filter(F.col("metric_type") == metric))
    groups = (
        flag_cohort(per_wafer, cohort_through(tables, suspect))
        .groupBy("in_cohort")
        .agg(F.sum("n").alias("readings"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))
    )
    # Over the two groups.
    both = Window.partitionBy()
    n, total, squares = (F.sum(c).over(both) for c in ("readings", "total", "squares"))
    overall = groups.withColumns({"n": n, "whole": total, "whole_squares": squares}).withColumns(
        {
            "mu": mean_of_sums(F.col("whole"), F.col("n"), 4),
            "sg": sigma_of_reading_sums(F.col("n"), F.col("whole"), F.col("whole_squares")),
            "group_mean": mean_of_sums(F.col("total"), F.col("readings"), 4),
        }
    )
    mu, sg = F.col("mu"), F.col("sg")
    return overall.select(
        F.when(F.col("in_cohort"), suspect.label).otherwise(OTHERS).alias("grp"),
        "readings",
        F.col("group_mean").cast(READING).alias("group_mean_cd"),
        mu.cast(READING).alias("overall_center"),
        (mu + sg * 3).cast(READING).alias("ucl"),
        ((F.col("group_mean") - mu) / sg).cast("decimal(6,3)").alias("group_mean_shift_in_sigma"),
    ).orderBy("grp")


def spc_by_tool(tables: Tables, metric: str = "CD") -> DataFrame:
    """Centre and sigma of one metric per measuring tool, highest centre first."""
    per_tool = (
        readings(tables, "tool_id")
        .filter(F.col("metric_type") == metric)
        .groupBy("tool_id")
        .agg(F.count(F.lit(1)).alias("readings"), _center().alias("center_line_cd"), _sigma())
    )
    return (
        per_tool.join(tables["tools"].select("tool_id", "tool_code"), "tool_id")
        .select("tool_code", "readings", "center_line_cd", "sigma")
        .orderBy(F.desc("center_line_cd"), "tool_code")
    )


def chart_points(tables: Tables, metric: str = "CD") -> DataFrame:
    """Every reading of one metric beside its centre line and limits, for a control chart."""
    chosen = tables["metrology_measurements"].filter(F.col("metric_type") == metric)
    stats = chosen.agg(_center(), _sigma())
    limits = stats.select(F.struct("center_line", "sigma").alias("limits")).scalar()
    center, sigma = limits["center_line"], limits["sigma"]
    points = chosen.select(
        "measurement_id",
        "measured_at",
        "value",
        center.alias("center_line"),
        _upper(center, sigma).alias("ucl"),
        _lower(center, sigma).alias("lcl"),
    )
    outside = (F.col("value") > F.col("ucl")) | (F.col("value") < F.col("lcl"))
    return points.withColumn("is_out", F.coalesce(outside, F.lit(False)))


def spc_by_chamber(tables: Tables, metric: str = "CD") -> DataFrame:
    """Centre and sigma of one metric over the wafers that ran in each chamber, highest centre first.

    A wafer's readings count once for every chamber it ran in. Pairs are made distinct and readings summed per wafer
    before they meet.
    """
    per_wafer = _sums_by_wafer(readings(tables, "wafer_id").filter(F.col("metric_type") == metric))
    runs = tables["process_runs"].filter(F.col("chamber_id").isNotNull())
    per_chamber = (
        runs.select("wafer_id", "chamber_id")
        .distinct()
        .join(per_wafer, "wafer_id")
        .groupBy("chamber_id")
        .agg(F.sum("n").alias("readings"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))
    )
    chambers = tables["chambers"].select("chamber_id", "tool_id", "chamber_code")
    tools = tables["tools"].select("tool_id", "tool_code")
    return (
        per_chamber.join(chambers, "chamber_id")
        .join(tools, "tool_id")
        .select(
            "tool_code",
            "chamber_code",
            "readings",
            mean_of_sums(F.col("total"), F.col("readings"), 4).cast(READING).alias("center_line_cd"),
            sigma_of_reading_sums(F.col("readings"), F.col("total"), F.col("squares")).cast(READING).alias("sigma"),
        )
        .orderBy(F.desc("center_line_cd"), "tool_code", "chamber_code")
    )


def metric_limits(tables: Tables) -> DataFrame:
    """Centre line and sigma per metric, rounded."""
    return tables["metrology_measurements"].groupBy("metric_type").agg(_center(), _sigma())


_SERIES = ["tool_id", "metric_type"]
_ORDER = ["measured_at", "measurement_id", "value"]


def _sliced(measured: DataFrame) -> DataFrame:
    """Readings with the number of the slice they lie in: slices hold about as many readings each, whatever the tool, metric or
    day, and follow each other in order of series, time, id and value."""
    return measured.repartitionByRange(*_SERIES, *_ORDER).withColumn("slice", F.spark_partition_id())


def spc_run_rules(tables: Tables, length: int = 8) -> DataFrame:
    """Runs of ``length`` or more consecutive readings on one side of their metric's centre line, per tool and metric.

    Readings follow each other by time, id and value; one on the rounded centre line ends a run. Slices of about equal size are searched
    apart. A slice then tells of its first and last run, and of those between in sums, and only these are put in order, so that
    no tool, metric or day is put in order in one task. The slices are read once: their numbers may differ from one
    execution to another, the result does not.
    """
    measured = readings(tables, "tool_id").select("measurement_id", *_SERIES, "value", "measured_at")
    side = F.signum(F.col("value") - F.col("center_line")).cast("int")
    limits = metric_limits(tables).select("metric_type", "center_line")
    sided = beside_limits(measured, limits).select(*_SERIES, *_ORDER, side.alias("side"))
    order = Window.partitionBy(*_SERIES, "slice").orderBy(*_ORDER)
    turns = F.when(F.lag("side").over(order).eqNullSafe(F.col("side")), 0).otherwise(1)
    is_long = (F.col("side") != 0) & (F.col("held") >= length)
    own = F.when(is_long, F.col("held"))
    run = F.struct("run", "side", "held")
    slices = (
        _sliced(sided)
        .withColumn("turn", turns)
        .withColumn("run", F.sum("turn").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*_SERIES, "slice", "run")
        .agg(F.count(F.lit(1)).alias("held"), F.min("side").alias("side"))
        .groupBy(*_SERIES, "slice")
        .agg(
            F.sum("held").alias("readings"),
            F.count(own).alias("runs"),
            F.sum(own).alias("in_runs"),
            F.max(F.when(F.col("side") != 0, F.col("held"))).alias("longest"),
            F.min(run).alias("first"),
            F.max(run).alias("last"),
        )
    )

    def less(whole: str, one: Callable[[str], Column], ends: list[str]) -> Column:
        """A slice's sum without its first and last run, which are counted with their neighbours."""
        parts = [F.when((F.col(f"{e}.side") != 0) & (F.col(f"{e}.held") >= length), one(e)).otherwise(0) for e in ends]
        both = F.when(F.col("first.run") == F.col("last.run"), parts[0]).otherwise(parts[0] + parts[1])
        return (F.coalesce(whole, F.lit(0)) - both).cast("long").alias(whole)

    ends = ["first", "last"]
    rest = [
        F.col("readings"),
        less("runs", lambda e: F.lit(1), ends),
        less("in_runs", lambda e: F.col(f"{e}.held"), ends),
        F.col("longest"),
    ]
    nothing = [F.lit(0).cast("long").alias("readings"), F.lit(0).cast("long").alias("runs"), F.lit(0).cast("long").alias("in_runs"), F.lit(None).cast("long").alias("longest")]
    first = F.struct(F.lit(0).alias("place"), F.col("first.side").alias("side"), F.col("first.held").alias("held"), *rest)
    last = F.struct(F.lit(1).alias("place"), F.col("last.side").alias("side"), F.col("last.held").alias("held"), *nothing)
    pieces = F.when(F.col("first.run") == F.col("last.run"), F.array(first)).otherwise(F.array(first, last))
    # Two rows per slice at most: a run goes on where it begins a slice and the run before it is on its side.
    along = Window.partitionBy(*_SERIES).orderBy("slice", "place")
    goes_on = (F.col("place") == 0) & (F.lag("side").over(along) == F.col("side"))
    return (
        slices.select(*_SERIES, "slice", F.inline(pieces))
        .withColumn("fresh", F.when(goes_on, 0).otherwise(1))
        .withColumn("chain", F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*_SERIES, "chain")
        .agg(
            F.min("side").alias("side"),
            F.sum("held").alias("held"),
            F.sum("readings").alias("readings"),
            F.sum("runs").alias("runs"),
            F.sum("in_runs").alias("in_runs"),
            F.max("longest").alias("longest"),
        )
        .groupBy(*_SERIES)
        .agg(
            F.sum("readings").alias("readings"),
            (F.sum("runs") + F.count(own)).alias("runs"),
            (F.sum("in_runs") + F.coalesce(F.sum(own), F.lit(0))).alias("readings_in_runs"),
            F.max(F.greatest("longest", F.when(F.col("side") != 0, F.col("held")))).alias("longest_run"),
        )
        .join(tables["tools"].select("tool_id", "tool_code"), "tool_id")
        .select("tool_code", "metric_type", "readings", "runs", "readings_in_runs", "longest_run")
        .orderBy("tool_code", "metric_type")
    )


def capability(tables: Tables) -> DataFrame:
    """Readings out of specification, Cp and Cpk per metric and pair of specification limits.

    Cp compares the width of the specification with six sigma, Cpk the distance of the mean from its nearer limit with
    three. NULL where sigma is, or is zero. Readings without both limits are left out.
    """
    limited = tables["metrology_measurements"].filter(F.col("spec_low").isNotNull() & F.col("spec_high").isNotNull())
    outside = (F.col("value") < F.col("spec_low")) | (F.col("value") > F.col("spec_high"))
    stats = limited.groupBy("metric_type", "spec_low", "spec_high").agg(
        F.count(F.lit(1)).alias("readings"),
        count_if(outside).alias("out_of_spec"),
        F.avg("value").alias("mu"),
        F.stddev_samp("value").alias("sg"),
    )
    sigma = F.nullif(F.col("sg"), F.lit(0.0))
    nearer = F.least(F.col("spec_high") - F.col("mu"), F.col("mu") - F.col("spec_low"))
    return stats.select(
        "metric_type",
        "spec_low",
        "spec_high",
        "readings",
        "out_of_spec",
        pct(F.col("out_of_spec"), F.col("readings")).alias("out_of_spec_pct"),
        ((F.col("spec_high") - F.col("spec_low")) / (sigma * 6)).cast("decimal(12,3)").alias("cp"),
        (nearer / (sigma * 3)).cast("decimal(12,3)").alias("cpk"),
    ).orderBy("metric_type", "spec_low", "spec_high")
