"""Joins whose left rows may share one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Keys that hold over one in HOT of all rows are hot: there are fewer than HOT of them, whatever the input's size.
HOT = 1_000
# Ways in which the rows of a hot key are dealt.
SALTS = 256


def with_facts(rows: DataFrame, facts: DataFrame, key: str, copies: Column, total: int) -> DataFrame:
    """rows left-joined with facts on key, no task with more than a small share of the rows.

    facts has one row a key, and `copies` says how many of the `total` rows have it. The hot keys, fewer than HOT, are sent to
    all tasks to salt their rows; their facts are repeated once for each salt. Rows without facts, null keys included, keep nulls.
    """
    is_hot = copies * HOT > total
    hot = facts.where(is_hot).select(key, F.lit(SALTS).alias("_salts"))
    salt = F.when(F.col("_salts").isNotNull(), F.monotonically_increasing_id() % F.col("_salts"))
    # A null key finds nothing; its rows are dealt by their own salts.
    salt = F.when(F.col(key).isNull(), F.monotonically_increasing_id() % SALTS).otherwise(F.coalesce(salt, F.lit(0)))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")
    every = F.sequence(F.lit(0).cast("long"), F.when(is_hot, SALTS - 1).otherwise(0).cast("long"))
    return dealt.join(facts.withColumn("_salt", F.explode(every)), [key, "_salt"], "left").drop("_salt")
