"""Which of the places that look bad are bad themselves, and which only share their wafers with one that is?

Work that is dealt by the same counter in two modules sends the wafers of a bad chamber through few places of the other module,
and a rank by mean yield then names those too. Here every place's gap to the other wafers is measured again among wafers that
did, and among those that did not, pass a stronger place. All of it comes from sums of yields per place and per pair of places
that look bad, added up in tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waferscope.operators.cohort import Tables
from waferscope.operators.yields import wafer_yield

CLEAN, SUSPECT, EXPLAINED = "clean", "suspect", "explained"
SCORE = "decimal(10,3)"


def yield_hundredths(tables: Tables) -> DataFrame:
    """Wafer yields in whole hundredths of a percent, so that sums are exact in any order."""
    return wafer_yield(tables).select("wafer_id", (F.col("yield_pct") * 100).cast("long").alias("y"))


def visits_of(tables: Tables, yields: DataFrame) -> DataFrame:
    """Each wafer once for each place it passed: an even number for a chamber, an odd one for a tool without chambers."""
    place = F.when(F.col("chamber_id").isNotNull(), F.col("chamber_id") * 2).otherwise(F.col("tool_id") * 2 + 1)
    passed = tables["process_runs"].select("wafer_id", place.cast("long").alias("place")).filter("place IS NOT NULL")
    return passed.distinct().join(yields, "wafer_id")


def places_of(tables: Tables) -> DataFrame:
    """The codes of each place that a wafer may pass."""
    tools = tables["tools"].select("tool_id", "tool_code")
    chambers = tables["chambers"].select("tool_id", (F.col("chamber_id") * 2).cast("long").alias("place"), "chamber_code")
    own = tools.select((F.col("tool_id") * 2 + 1).cast("long").alias("place"), "tool_code", F.lit(None).cast("string").alias("chamber_code"))
    return chambers.join(tools, "tool_id").select("place", "tool_code", "chamber_code").unionByName(own)


def _weighed(n: Column, total: Column, n_all: Column, total_all: Column) -> tuple[Column, Column]:
    """A stratum's weight, and its weight times the gap between the mean of n wafers and that of the rest; 0 where either is empty."""
    n, total, n_all, total_all = (c.cast("double") for c in (n, total, n_all, total_all))
    rest = n_all - n
    both = (n > 0) & (rest > 0)
    weight = n * rest / F.nullif(n_all, F.lit(0.0))
    gap = total / F.nullif(n, F.lit(0.0)) - (total_all - total) / F.nullif(rest, F.lit(0.0))
    return F.when(both, weight).otherwise(0.0), F.when(both, weight * gap).otherwise(0.0)


def _score(weight: Column, weighed: Column, sigma: Column) -> Column:
    """How many standard errors a gap lies from 0; null where there is nothing to compare."""
    return weighed / F.nullif(F.sqrt(weight), F.lit(0.0)) / F.nullif(sigma, F.lit(0.0))


def _given(o: str, s: str, whole: Column) -> tuple[Column, Column]:
    """Weight and weighed gap of place o, compared among the wafers through s and among those not through s."""
    c = F.col
    through = _weighed(c("n"), c("total"), c(f"n_{s}"), c(f"total_{s}"))
    around = _weighed(
        c(f"n_{o}") - c("n"), c(f"total_{o}") - c("total"), whole["n"] - c(f"n_{s}"), whole["total"] - c(f"total_{s}")
    )
    return through[0] + around[0], through[1] + around[1]


def conditional_commonality(tables: Tables, limit: float = 3.0) -> DataFrame:
    """Every place that wafers with a yield passed, with its gap and whether a stronger place explains it.

    A place is a chamber, or a tool where runs name no chamber (``chamber_code`` is null). ``gap_pct`` is the mean wafer yield
    through it less that of all other wafers, ``z_score`` the same in standard errors; from ``-limit`` on down a place looks bad.
    It is ``explained`` if, compared among wafers alike in passing a stronger such place, it no longer looks bad
    or cannot be told apart, while the stronger one still does when compared among wafers alike in passing it. Of several the strongest
    is ``explained_by``, and ``z_given`` the score that is left. The others that look bad are ``suspect``, the rest ``clean``. A
    place that all wafers pass has no gap and is clean. Ties in strength go to chambers and tools of a lower id.

    Pairs are only made of places that look bad and that a wafer passed both, so a wafer gives few; sums leave a task per pair.
    """
    yields = yield_hundredths(tables)
    sums = yields.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("y"), F.lit(0)).alias("total"),
            F.sum((F.col("y") * F.col("y")).cast("decimal(38,0)")).cast("double").alias("squares"),
        ).alias("whole")
    )
    whole = sums.scalar()
    n_all, total_all = whole["n"].cast("double"), whole["total"].cast("double")
    spread = (whole["squares"] - total_all * total_all / F.nullif(n_all, F.lit(0.0))) / F.nullif(n_all - 1, F.lit(0.0))
    sigma = F.sqrt(spread)

    visits = visits_of(tables, yields)
    passed = visits.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("total"))
    weight, weighed = _weighed(F.col("n"), F.col("total"), whole["n"], whole["total"])
    scored = passed.select(
        "place", "n", "total", (weighed / F.nullif(weight, F.lit(0.0))).alias("gap"), _score(weight, weighed, sigma).alias("z")
    )
    bad = scored.filter(F.col("z") <= -limit)

    def named(df: DataFrame, end: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{c}_{end}") for c in ("place", "n", "total", "z")])

    met = visits.join(bad.select("place", "z"), "place")
    left = met.select("wafer_id", "y", F.col("place").alias("place_o"), F.struct("z", "place").alias("strength_o"))
    right = met.select("wafer_id", F.col("place").alias("place_s"), F.struct("z", "place").alias("strength_s"))
    shared = (
        left.join(right, "wafer_id")
        .filter(F.col("strength_s") < F.col("strength_o"))
        .groupBy("place_o", "place_s")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("total"))
        .join(named(bad, "o"), "place_o")
        .join(named(bad, "s"), "place_s")
    )
    compared = shared.select(
        "place_o", "place_s", "z_s",
        _score(*_given("o", "s", whole), sigma).alias("z_given"),
        _score(*_given("s", "o", whole), sigma).alias("z_back"),
    )
    gone = F.coalesce(F.col("z_given") > -limit, F.lit(True))
    stays = F.coalesce(F.col("z_back") <= -limit, F.col("z_given").isNull())
    reasons = (
        compared.filter(gone & stays)
        .groupBy("place_o")
        .agg(F.min(F.struct("z_s", "place_s", "z_given")).alias("by"))
        .select(F.col("place_o").alias("place"), F.col("by.place_s").alias("by"), F.col("by.z_given").alias("z_given"))
    )
    places = places_of(tables)
    label = F.concat_ws("/", "tool_code", "chamber_code")
    explained = reasons.join(places.select(F.col("place").alias("by"), label.alias("explained_by")), "by").drop("by")
    verdict = F.when(F.col("explained_by").isNotNull(), EXPLAINED).when(F.col("z") <= -limit, SUSPECT).otherwise(CLEAN)
    return (
        scored.join(places, "place")
        .join(explained, "place", "left")
        .select(
            "tool_code",
            "chamber_code",
            F.col("n").alias("wafers_through"),
            (F.col("gap") / 100).cast(SCORE).alias("gap_pct"),
            F.col("z").cast(SCORE).alias("z_score"),
            verdict.alias("verdict"),
            "explained_by",
            F.col("z_given").cast(SCORE).alias("z_given"),
        )
        .orderBy(F.col("z_score").asc_nulls_last(), "tool_code", "chamber_code")
    )


def suspects(tables: Tables, limit: float = 3.0) -> DataFrame:
    """The places that look bad and that no other explains, worst first; none where no place looks bad."""
    found = conditional_commonality(tables, limit).filter(F.col("verdict") == SUSPECT)
    return found.select("tool_code", "chamber_code", "wafers_through", "gap_pct", "z_score").orderBy(
        "z_score", "tool_code", "chamber_code"
    )
