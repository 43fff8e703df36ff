"""The chamber under suspicion and the wafers that passed through it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Suspect:
    """A chamber by its business key. Both parts are scalar expressions, so a suspect found by
    another analysis stays inside the query and is never collected."""

    tool_code: Column
    chamber_code: Column

    @classmethod
    def named(cls, tool_code: str, chamber_code: str) -> Suspect:
        return cls(F.lit(tool_code), F.lit(chamber_code))

    @classmethod
    def from_row(cls, df: DataFrame) -> Suspect:
        """From a DataFrame of at most one row with ``tool_code`` and ``chamber_code``."""
        row = df.select(F.struct("tool_code", "chamber_code").alias("suspect")).scalar()
        return cls(row["tool_code"], row["chamber_code"])

    @property
    def label(self) -> Column:
        return F.concat(self.tool_code, F.lit("/"), self.chamber_code)


def suspect_tool(tables: Tables, suspect: Suspect, column: str) -> Column:
    """One attribute of the suspect's tool. Fails if the tool code is not unique."""
    return tables["tools"].filter(F.col("tool_code") == suspect.tool_code).select(column).scalar()


def cohort_through(tables: Tables, suspect: Suspect) -> DataFrame:
    """The distinct wafers that ran on a tool of the suspect's code in a chamber of the suspect's code.

    Runs are reduced by semi joins with the filtered chambers and tools, whose size Spark knows when it chooses how.
    """
    chambers = tables["chambers"].filter(F.col("chamber_code") == suspect.chamber_code).select("chamber_id")
    tools = tables["tools"].filter(F.col("tool_code") == suspect.tool_code).select("tool_id")
    return (
        tables["process_runs"]
        .select("wafer_id", "tool_id", "chamber_id")
        .join(chambers, "chamber_id", "left_semi")
        .join(tools, "tool_id", "left_semi")
        .select("wafer_id")
        .distinct()
    )


def flag_cohort(df: DataFrame, cohort: DataFrame, name: str = "in_cohort") -> DataFrame:
    """Add a boolean telling whether the row's wafer is in ``cohort`` (distinct wafers)."""
    members = cohort.select("wafer_id", F.lit(True).alias(name))
    return df.join(members, "wafer_id", "left").withColumn(name, F.coalesce(name, F.lit(False)))
