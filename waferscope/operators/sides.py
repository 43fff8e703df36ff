"""How rows are ranked without gathering them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def rank_by_value(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``rank() over (order by value)`` for a percentage: ties share a rank and leave a gap behind them.

    Distinct values are counted, ranked within hundredths of a point, and moved up by the rows of smaller hundredths. A
    decimal(9,6) has at most 10,000 distinct values in a hundredth, and there are 10,001 hundredths, so no ordered pass
    is longer than that, however many rows there are.
    """
    steps = df.groupBy(value).agg(F.count(F.lit(1)).alias("ties")).withColumn("slice", F.floor(F.col(value) * 100))
    slices = steps.groupBy("slice").agg(F.sum("ties").alias("held"))
    below = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("slice", F.coalesce(F.sum("held").over(below), F.lit(0)).alias("offset"))
    before = Window.partitionBy("slice").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    within = steps.withColumn("earlier", F.coalesce(F.sum("ties").over(before), F.lit(0)))
    ranked = within.join(offsets, "slice").select(value, (F.col("offset") + F.col("earlier") + 1).cast("int").alias(name))
    return df.join(ranked, value)
