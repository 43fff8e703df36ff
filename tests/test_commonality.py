from decimal import Decimal
from statistics import stdev

from conftest import dies, rows, run, wafers
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F
from waferscope.functions.spread import exact_square, sigma_of_sums
from waferscope.operators import commonality
from waferscope.operators.cohort import Suspect, cohort_through
from waferscope.operators.sides import rank_by_value


def test_unchambered_runs_and_repeats_do_not_count(fab):
    tables = fab(
        wafers=wafers(1, 2),
        bin_results=dies(1, 1, 1) + dies(2, 3, 1),
        process_runs=[run(1, 1, 1), run(1, 1, 1, step=2), run(2, 1, 1), run(2, 1, None, step=2)],
    )
    assert rows(commonality.commonality_rank(tables)) == [("E1", "A", 2, Decimal("62.50"), 1)]


def test_means_weight_wafers_equally_whatever_their_dies(fab):
    tables = fab(
        wafers=wafers(1, 2),
        bin_results=dies(1, 1, 0) + dies(2, 0, 9),
        process_runs=[run(1, 1, 1), run(2, 1, 1)],
    )
    assert rows(commonality.commonality_rank(tables))[0][3] == Decimal("50.00")


def test_equal_means_share_a_rank_and_leave_a_gap(fab):
    tables = fab(
        wafers=wafers(1, 2, 3),
        bin_results=dies(1, 1, 1) + dies(2, 2, 2) + dies(3, 1, 0),
        process_runs=[run(1, 1, 1), run(2, 1, 2), run(3, 2, 3)],
    )
    assert [(r[0], r[1], r[4]) for r in rows(commonality.commonality_rank(tables))] == [
        ("E1", "A", 1),
        ("E1", "B", 1),
        ("E2", "A", 3),
    ]
    assert rows(commonality.find_suspect(tables)) == [("E1", "A", 1, Decimal("50.00"))]


def test_peers_are_of_the_same_tool_type_and_counted_as_pairs(fab):
    tables = fab(
        wafers=wafers(1, 2, 3),
        bin_results=dies(1, 1, 3) + dies(2, 1, 1) + dies(3, 1, 0),
        process_runs=[run(1, 1, 1), run(2, 1, 2), run(2, 2, 3, step=2), run(3, 2, 3), run(1, 3, 4)],
    )
    suspect = Suspect.named("E1", "A")
    assert rows(commonality.suspect_vs_peers(tables, suspect)) == [
        ("Suspect: E1/A", 1, Decimal("25.00"), Decimal("25.00"), Decimal("25.00"), None),
        ("Other Etcher chambers", 3, Decimal("66.67"), Decimal("50.00"), Decimal("100.00"), Decimal("28.87")),
    ]


def test_cohort_needs_both_the_tool_of_the_run_and_the_chamber_code(fab):
    tables = fab(
        wafers=wafers(1, 2, 3),
        process_runs=[run(1, 1, 1), run(1, 1, 1, step=2), run(2, 2, 3), run(3, 1, None)],
    )
    assert rows(cohort_through(tables, Suspect.named("E1", "A"))) == [(1,)]
    assert rows(cohort_through(tables, Suspect.named("E1", "Z"))) == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 30), min_size=1, max_size=40))
def test_rank_over_distinct_values_is_rank(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    plain = df.withColumn("r", F.rank().over(Window.orderBy("v")))
    assert sorted(rows(rank_by_value(df, "v", "r").select("id", "v", "r"))) == sorted(rows(plain))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 10000)), min_size=2, max_size=30))
def test_sigma_merged_from_keys_is_the_sample_deviation(spark, pairs):
    df = spark.createDataFrame([(k, Decimal(v) / 100) for k, v in pairs], "k int, v decimal(5,2)")
    v = F.col("v")
    keys = df.groupBy("k").agg(F.count(v).alias("n"), F.sum(v).alias("t"), F.sum(exact_square(v)).alias("q"))
    merged = keys.agg(sigma_of_sums(F.sum("n"), F.sum("t"), F.sum("q")).alias("s")).first().s
    assert abs(merged - stdev([v / 100 for _, v in pairs])) < 1e-9
