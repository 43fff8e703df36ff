"""Is a place's gap in yield more than chance, of all the places that were looked at?

Wafers through a place are compared with all others by their ranks, which a few very bad wafers cannot sway. Yields have two digits, so
ranks come from a histogram of at most 10,001 values, and a place's rank sum from its own histogram: both are added up in
tasks, ties included. The more places there are, the more look bad by chance: false discoveries are held down over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from waferscope.operators.attribution import places_of, visits_of, yield_hundredths
from waferscope.operators.cohort import Tables

SCORE, CHANCE = "decimal(10,3)", "decimal(12,9)"
# Beyond so many standard errors a chance is too small for nine digits; scores have three, so there are 38,001 at most.
FARTHEST = 38

# A published rational fit of the complementary error function, to 1.2e-7 of its value.
_FIT = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def two_sided(score: Column) -> Column:
    """The chance that a standard normal lies at least as far from 0 as score."""
    x = F.abs(score) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + x / 2)
    fitted = F.lit(_FIT[-1])
    for term in reversed(_FIT[:-1]):
        fitted = term + t * fitted
    return F.least(t * F.exp(-x * x + fitted), F.lit(1.0))


def chamber_significance(tables: Tables) -> DataFrame:
    """Every place that wafers with a yield passed, with how far the ranks of their yields lie from chance.

    ``rank_z`` is the rank-sum score against all other wafers, corrected for ties, negative where yields are lower; ``p_value`` the
    two-sided chance of one as far out, ``q_value`` the share of places as far out or farther that chance
    alone would put there (Benjamini and Hochberg). A place that all wafers passed, or yields that are all equal, give nulls. Places are chambers, or
    tools where runs name no chamber. Scores are rounded to three digits before chances are taken.
    """
    yields = yield_hundredths(tables)
    values = yields.groupBy("y").agg(F.count(F.lit(1)).alias("ties"))
    # One row for each value from 0.00 to 100.00.
    below = F.sum("ties").over(Window.orderBy("y").rowsBetween(Window.unboundedPreceding, -1))
    ranks = values.select("y", (2 * F.coalesce(below, F.lit(0)) + F.col("ties") + 1).alias("rank_twice"))
    ties = F.col("ties").cast("decimal(12,0)")
    whole = values.agg(
        F.struct(F.sum("ties").alias("n"), F.sum((ties * ties * ties).cast("decimal(38,0)") - ties).cast("double").alias("tied")).alias("whole")
    ).scalar()
    passed = visits_of(tables, yields).groupBy("place", "y").agg(F.count(F.lit(1)).alias("held"))
    sums = (
        passed.join(ranks, "y")
        .groupBy("place")
        .agg(F.sum("held").alias("n"), F.sum((F.col("held") * F.col("rank_twice")).cast("decimal(38,0)")).cast("double").alias("ranks_twice"))
    )
    n, everyone = F.col("n").cast("double"), whole["n"].cast("double")
    others = everyone - n
    above_least = F.col("ranks_twice") / 2 - n * (n + 1) / 2
    spread = n * others / 12 * ((everyone + 1) - whole["tied"] / F.nullif(everyone * (everyone - 1), F.lit(0.0)))
    score = ((above_least - n * others / 2) / F.nullif(F.sqrt(F.greatest(spread, F.lit(0.0))), F.lit(0.0))).cast(SCORE)
    scored = sums.select("place", "n", score.alias("rank_z")).withColumn(
        "far", F.when(F.col("rank_z").isNotNull(), F.least(F.abs("rank_z"), F.lit(FARTHEST).cast(SCORE)))
    )
    # One row for each score: at most 1,000 to a standard error.
    levels = scored.filter("far IS NOT NULL").groupBy("far").agg(F.count(F.lit(1)).alias("held"))
    farther = F.sum("held").over(Window.orderBy(F.desc("far")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    all_places = F.sum("held").over(Window.partitionBy())
    shared = levels.withColumn("p", two_sided(F.col("far").cast("double"))).withColumn("raw", F.col("p") * all_places / farther)
    nearest = Window.orderBy("far").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = shared.select("far", F.col("p").cast(CHANCE).alias("p_value"), F.least(F.min("raw").over(nearest), F.lit(1.0)).cast(CHANCE).alias("q_value"))
    return (
        scored.join(found, "far", "left")
        .join(places_of(tables), "place")
        .select("tool_code", "chamber_code", F.col("n").alias("wafers_through"), "rank_z", "p_value", "q_value")
        .orderBy(F.col("rank_z").asc_nulls_last(), "tool_code", "chamber_code")
    )
