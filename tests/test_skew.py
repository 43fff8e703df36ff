"""One key holding a large part of all rows: same results, and no task that has to hold it."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from waferscope.operators import commonality, defects, drift, spc, wafer_map, yields
from waferscope.operators.cohort import Suspect

HOT_ROWS, COLD_WAFERS = 6000, 300


@pytest.fixture
def hot(spark, fab):
    """Wafer 0 has as many dies, runs, inspections and readings as a third of the fab; it passes half its dies."""
    tables = fab()
    many = spark.range(HOT_ROWS).select(F.lit(0).cast("long").alias("wafer_id"), F.col("id").alias("n"))
    few = spark.range(1, COLD_WAFERS + 1).select(
        F.col("id").alias("wafer_id"), F.explode(F.expr("sequence(0L, 9L)")).alias("n")
    )
    facts = many.unionByName(few)
    odd = F.col("n") % 2 == 1
    tables["wafers"] = spark.range(COLD_WAFERS + 1).select(
        F.col("id").alias("wafer_id"), F.lit(1).cast("long").alias("lot_id")
    )
    tables["bin_results"] = facts.select(
        "wafer_id", F.when(odd, 1).otherwise(2).cast("long").alias("bin_code_id"), F.col("n").alias("die_x"), F.lit(1).alias("die_y")
    )
    tables["process_runs"] = facts.select(
        F.monotonically_increasing_id().alias("process_run_id"),
        "wafer_id",
        F.lit(1).cast("long").alias("tool_id"),
        F.when(F.col("wafer_id") == 0, 1).otherwise(2).cast("long").alias("chamber_id"),
    )
    tables["defect_inspections"] = facts.select(
        (F.col("wafer_id") * HOT_ROWS + F.col("n")).alias("inspection_id"), "wafer_id", F.lit(1).alias("defect_count")
    )
    tables["defects"] = tables["defect_inspections"].select(
        F.col("inspection_id").alias("defect_id"), "inspection_id", F.lit(1).cast("long").alias("defect_type_id")
    )
    tables["metrology_measurements"] = facts.select(
        "wafer_id", F.lit(1).cast("long").alias("tool_id"), F.lit("CD").alias("metric_type"), (F.col("n") % 10).cast("decimal(12,4)").alias("value")
    )
    return tables


def test_results_are_whole(hot):
    by_wafer = {r.wafer_id: r for r in yields.wafer_yield(hot).collect()}
    assert (by_wafer[0].total_dies, by_wafer[0].yield_pct) == (HOT_ROWS, Decimal("50.00"))
    assert dict(rows(defects.wafer_defects(hot)))[0] == HOT_ROWS
    assert [r[:4] for r in rows(commonality.commonality_rank(hot))] == [
        ("E1", "A", 1, Decimal("50.00")),
        ("E1", "B", COLD_WAFERS, Decimal("50.00")),
    ]
    shift = rows(spc.spc_group_shift(hot, Suspect.named("E1", "A")))
    assert [r[:3] for r in shift] == [("E1/A", HOT_ROWS, Decimal("4.5000")), ("Others", 10 * COLD_WAFERS, Decimal("4.5000"))]
    assert rows(defects.defect_mix_by_cohort(hot, Suspect.named("E1", "A"))) == [
        ("Particle", Decimal("100.00"), Decimal("100.00"))
    ]


def test_a_wafer_is_one_map_and_its_sites_are_counted_first(hot):
    maps = wafer_map.wafer_map(hot).filter("wafer_id = 0").collect()
    assert len(maps) == 1 and len(maps[0].dies) == HOT_ROWS
    assert wafer_map.wafer_sites(hot).filter("wafer_id = 0").count() == HOT_ROWS


def test_facts_are_reduced_before_the_shuffle(hot):
    """The hot wafer leaves each task as one row per chamber, not one row per run."""
    plan = commonality.commonality_rank(hot)._jdf.queryExecution().executedPlan().toString()
    for exchange in ("Exchange hashpartitioning(wafer_id",):
        first = plan.index(exchange)
        assert "HashAggregate" in plan[first : first + 600]


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts, and partitions counted as skewed at a size the test data reaches."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_a_hot_run_is_split_in_the_join_to_its_readings(spark, fab, shuffled_joins):
    """A third of all readings sit on one run; the join leaves Spark free to split its partition."""
    tables = fab()
    tables["process_runs"] = spark.range(2000).select(
        F.col("id").alias("process_run_id"), F.col("id").alias("wafer_id"), (F.col("id") % 3 + 1).alias("tool_id")
    )
    n = F.col("id")
    tables["metrology_measurements"] = spark.range(0, 60000, 1, 16).select(
        F.when(n % 3 == 0, F.lit(7)).otherwise(n % 2000).alias("process_run_id"),
        F.lit("CD").alias("metric_type"),
        (n % 100).cast("decimal(12,4)").alias("value"),
    )
    df = spc.spc_by_tool(tables)
    found = {r.tool_code: r.readings for r in df.collect()}
    assert sum(found.values()) == 60000
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_results_do_not_depend_on_broadcasts(hot, shuffled_joins):
    test_results_are_whole(hot)


def test_a_tools_day_with_a_third_of_all_readings_is_cut_into_slices(spark, fab):
    """Every slice of the run rules is small, and the runs are those of one pass."""
    tables = fab()
    hot = spark.range(HOT_ROWS).select(F.lit(1).cast("long").alias("tool_id"), F.lit("CD").alias("metric_type"), F.col("id").alias("n"))
    cold = spark.range(2 * HOT_ROWS).select((F.col("id") % 2 + 2).alias("tool_id"), F.concat(F.lit("M"), F.col("id") % 5).alias("metric_type"), F.col("id").alias("n"))
    tables["metrology_measurements"] = hot.unionByName(cold).select(
        F.col("n").alias("measurement_id"),
        "tool_id",
        "metric_type",
        F.expr("CAST(n div 13 % 2 * 2 AS DECIMAL(12,4))").alias("value"),
        F.expr("timestampadd(SECOND, CAST(n AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("measured_at"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = spc._sliced(tables["metrology_measurements"].withColumn("side", F.lit(1)))
        most = max(r["count"] for r in sliced.groupBy("slice").count().collect())
        assert most < HOT_ROWS * 3 / 4
        found = {(r.tool_code, r.metric_type): r for r in spc.spc_run_rules(tables).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    row = found["E1", "CD"]
    assert (row.readings, row.runs, row.readings_in_runs, row.longest_run) == (HOT_ROWS, 461, HOT_ROWS - HOT_ROWS % 13 % 8, 13)


@pytest.mark.parametrize("operator", [spc.spc_limits, spc.spc_run_rules, drift.cusum_by_tool])
def test_a_metrics_readings_do_not_meet_in_one_task(spark, fab, shuffled_joins, operator):
    """Two thirds of all readings are of one metric; they stay where they are until they are dealt by tool and time."""
    tables = fab()
    tables["metrology_measurements"] = spark.range(0, HOT_ROWS, 1, 8).select(
        F.col("id").alias("measurement_id"),
        (F.col("id") % 3 + 1).alias("tool_id"),
        F.concat(F.lit("M"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 2)).alias("metric_type"),
        (F.col("id") % 10).cast("decimal(12,4)").alias("value"),
        F.expr("timestampadd(MINUTE, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("measured_at"),
    )
    df = operator(tables)
    assert sum(r.readings for r in df.collect()) == HOT_ROWS
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [metric_type" in plan and "SortMergeJoin [metric_type" not in plan
