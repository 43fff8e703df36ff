"""Do the conclusions still hold? Directional checks, each one row: ``check_name, measured, status``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from waferscope.functions.decimals import PERCENT, mean_of_sums
from waferscope.operators.cohort import Suspect, Tables, cohort_through, flag_cohort, suspect_tool
from waferscope.operators.commonality import commonality_rank
from waferscope.operators.correlation import defect_yield_points
from waferscope.operators.defects import defect_mix_by_cohort, defect_pareto, wafer_defects
from waferscope.operators.yields import wafer_yield, yield_by_product, yield_by_tool
from waferscope.plans.load_checks import metric_sums_by_wafer

MEASURED = "decimal(12,3)"

# Status words and check names that reports are read by. A name with a gap takes the
# suspect's tool or chamber.
PASS, CHECK = "PASS", "**CHECK**"
PRODUCT_FLAT = "B1 yield: product spread flat"
TOOL_TRAILS = ("B1 yield: ", " trails peers")
CD_DRIFTS = "B3 spc: CD drift present (bad-others, nm)"
OVERLAY_STEADY = "B3 spc: Overlay NOT shifted"
FILM_STEADY = "B3 spc: Film Thickness NOT shifted"
WORST_CHAMBER = ("B4 commonality: ", " is worst chamber")
BANDS_ORDERED = "B5 correlation: high-defect band yields less"
PARETO_CLOSES = "B2 pareto: cumulative share closes at 100"
TYPE_OVER_INDEXES = "B2 pareto: {} over-indexes"


@dataclass(frozen=True)
class MetricLimit:
    """How far a metric's cohort mean may, or must, be from the mean of all other wafers."""

    name: str
    metric_type: str
    limit: str
    must_exceed: bool


# The metric expected to drift and the two that must not.
METRIC_LIMITS = (
    MetricLimit(CD_DRIFTS, "CD", "0.5", True),
    MetricLimit(OVERLAY_STEADY, "Overlay", "0.5", False),
    MetricLimit(FILM_STEADY, "Film Thickness", "3.0", False),
)


def _about(name: tuple[str, str], subject: Column) -> Column:
    return F.concat(F.lit(name[0]), subject, F.lit(name[1]))


def _verdict(name: str | Column, measured: Column, holds: Column) -> list[Column]:
    return [
        (name if isinstance(name, Column) else F.lit(name)).alias("check_name"),
        measured.cast(MEASURED).alias("measured"),
        F.when(holds, PASS).otherwise(CHECK).alias("status"),
    ]


def view_totals_check(tables: Tables, expected_wafers: int | Column) -> DataFrame:
    """The two base views cover the expected wafers."""
    expected = expected_wafers if isinstance(expected_wafers, Column) else F.lit(expected_wafers)
    yields = wafer_yield(tables).agg(F.count(F.lit(1)).alias("n")).scalar()
    both = (F.col("yield_wafers") == expected) & (F.col("defect_wafers") == expected)
    return (
        wafer_defects(tables)
        .agg(F.count(F.lit(1)).alias("defect_wafers"), F.sum("defect_count").alias("total_defects"))
        .select(yields.alias("yield_wafers"), "defect_wafers", "total_defects")
        .select("*", F.when(both, PASS).otherwise(CHECK).alias("status"))
    )


def check_product_flat(tables: Tables, limit: str = "1.0") -> DataFrame:
    spread = yield_by_product(tables).agg((F.max("yield_pct") - F.min("yield_pct")).alias("spread"))
    return spread.select(
        *_verdict(PRODUCT_FLAT, F.col("spread"), F.col("spread") < F.lit(limit).cast("decimal(5,2)"))
    )


def check_tool_trails(tables: Tables, suspect: Suspect) -> DataFrame:
    """The suspect's tool yields less than the mean of the other tools of its type."""
    is_suspect = F.col("tool_code") == suspect.tool_code
    sides = (
        yield_by_tool(tables)
        .filter(F.col("tool_type") == suspect_tool(tables, suspect, "tool_type"))
        .agg(
            F.max(F.when(is_suspect, F.col("yield_pct"))).alias("own"),
            F.avg(F.when(~is_suspect, F.col("yield_pct"))).alias("peers"),
        )
    )
    name = _about(TOOL_TRAILS, suspect.tool_code)
    return sides.select(*_verdict(name, F.col("own"), F.col("own") < F.col("peers")))


def check_metric_shift(
    tables: Tables, suspect: Suspect, limits: Sequence[MetricLimit] = METRIC_LIMITS
) -> DataFrame:
    """One row per limit, from one pass over the readings."""
    wanted = {limit.metric_type for limit in limits}
    sums = flag_cohort(metric_sums_by_wafer(tables), cohort_through(tables, suspect)).filter(
        F.col("metric_type").isin(*wanted)
    )

    def mean(member: Column) -> Column:
        rows = F.sum(F.when(member, F.col("n")))
        return mean_of_sums(F.sum(F.when(member, F.col("total"))), rows, 4)

    inside = F.col("in_cohort")
    # Aggregated to one row of one column per limit, so a metric without readings still reports.
    differences = sums.agg(
        *[
            (mean(inside & (F.col("metric_type") == limit.metric_type))
             - mean(~inside & (F.col("metric_type") == limit.metric_type))).alias(f"d{i}")
            for i, limit in enumerate(limits)
        ]
    )

    def verdict(i: int, limit: MetricLimit) -> Column:
        bound = F.lit(limit.limit).cast("decimal(12,4)")
        measured = F.col(f"d{i}") if limit.must_exceed else F.abs(f"d{i}")
        holds = measured > bound if limit.must_exceed else measured < bound
        return F.struct(*_verdict(limit.name, measured, holds))

    rows = F.array(*[verdict(i, limit) for i, limit in enumerate(limits)])
    return differences.select(F.inline(rows))


def check_worst_chamber(tables: Tables, suspect: Suspect) -> DataFrame:
    is_suspect = (F.col("tool_code") == suspect.tool_code) & (F.col("chamber_code") == suspect.chamber_code)
    found = commonality_rank(tables).agg(F.max(F.when(is_suspect, F.col("worst_rank"))).alias("worst_rank"))
    name = _about(WORST_CHAMBER, suspect.label)
    return found.select(*_verdict(name, F.col("worst_rank"), F.col("worst_rank") == 1))


def check_band_order(tables: Tables, low: int = 3, high: int = 7) -> DataFrame:
    """Wafers with many defects yield less than wafers with few; measured is the gap."""
    load = F.col("defect_count")
    bands = defect_yield_points(tables).agg(
        F.avg(F.when(load <= low, F.col("yield_pct"))).alias("low"),
        F.avg(F.when(load >= high, F.col("yield_pct"))).alias("high"),
    )
    return bands.select(
        *_verdict(
            BANDS_ORDERED,
            (F.col("low") - F.col("high")).cast(PERCENT),
            F.col("high") < F.col("low"),
        )
    )


def conclusion_report(
    tables: Tables, suspect: Suspect, limits: Sequence[MetricLimit] = METRIC_LIMITS
) -> DataFrame:
    """All of the above in one table. Shared shuffles are planned once and reused."""
    return reduce(
        DataFrame.unionByName,
        [
            check_product_flat(tables),
            check_tool_trails(tables, suspect),
            check_metric_shift(tables, suspect, limits),
            check_worst_chamber(tables, suspect),
            check_band_order(tables),
        ],
    )


def check_pareto(tables: Tables, suspect: Suspect, defect_names: Sequence[str] = ("Particle", "Flake")) -> DataFrame:
    """The running share closes at 100, and each named type is over-represented in the cohort."""
    closing = defect_pareto(tables).agg(F.max("cumulative_pct").alias("closing"))
    closed = closing.select(
        *_verdict(PARETO_CLOSES, F.col("closing"), F.col("closing") == 100)
    )
    share_gap = F.col("pct_bad_group") - F.col("pct_others_group")
    gaps = defect_mix_by_cohort(tables, suspect).agg(
        *[F.max(F.when(F.col("defect_name") == name, share_gap)).alias(f"g{i}") for i, name in enumerate(defect_names)]
    )
    excess = [
        F.struct(*_verdict(TYPE_OVER_INDEXES.format(name), F.col(f"g{i}"), F.col(f"g{i}") > 0))
        for i, name in enumerate(defect_names)
    ]
    return closed.unionByName(gaps.select(F.inline(F.array(*excess))))
