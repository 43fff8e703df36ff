from decimal import Decimal

from conftest import dies, rows, run, wafers
from pyspark.sql import functions as F
from waferscope.operators import correlation, wafer_map
from waferscope.operators.cohort import Suspect


def test_band_edges(spark):
    counts = [0, 3, 4, 6, 7, 9, 10, 99]
    df = spark.createDataFrame([(c,) for c in counts], "c int")
    assert [r[0] for r in df.select(correlation.defect_band(F.col("c"))).collect()] == [
        "0-3  (low)",
        "0-3  (low)",
        "4-6  (medium)",
        "4-6  (medium)",
        "7-9  (high)",
        "7-9  (high)",
        "10+  (very high)",
        "10+  (very high)",
    ]


def loaded(fab):
    """Wafer 1: 4 defects, 50 %; wafer 2: clean, 100 %; wafer 3 has no dies."""
    return fab(
        wafers=wafers(1, 2, 3),
        bin_results=dies(1, 1, 1) + dies(2, 2, 0),
        process_runs=[run(1, 1, 1), run(2, 1, 2)],
        defect_inspections=[{"inspection_id": 1, "wafer_id": 1, "defect_count": 4}],
        defects=[{"inspection_id": 1, "defect_type_id": k} for k in (1, 1, 2, 3)],
    )


def test_points_bands_and_trend(fab):
    tables = loaded(fab)
    assert sorted(rows(correlation.defect_yield_points(tables))) == [(1, 4, Decimal("50.00")), (2, 0, Decimal("100.00"))]
    assert rows(correlation.yield_by_defect_band(tables)) == [
        ("0-3  (low)", 1, Decimal("100.00"), Decimal("0.00")),
        ("4-6  (medium)", 1, Decimal("50.00"), Decimal("4.00")),
    ]
    assert rows(correlation.defect_yield_trend(tables)) == [
        (2, Decimal("-12.500000"), Decimal("100.000000"), Decimal("-1.000000"))
    ]


def test_fingerprint(fab):
    assert rows(correlation.cohort_fingerprint(loaded(fab), Suspect.named("E1", "A"))) == [
        ("E1/A (bad)", 1, Decimal("50.00"), Decimal("4.00"), Decimal("75.00")),
        ("All others", 1, Decimal("100.00"), Decimal("0.00"), None),
    ]


def test_map_keeps_every_result_in_one_row(fab):
    repeated = {"bin_result_id": 9, "wafer_id": 1, "bin_code_id": 1, "die_x": 0, "die_y": 1}
    far = {"bin_result_id": 10, "wafer_id": 1, "bin_code_id": 2, "die_x": 70, "die_y": 1}
    tables = fab(wafers=wafers(1), bin_results=dies(1, 1, 1) + [repeated, far])
    (found,) = rows(wafer_map.wafer_map(tables))
    assert (found[0], [tuple(d) for d in found[1]]) == (1, [(0, 1, True, 2), (1, 1, False, 1), (70, 1, False, 1)])


def test_a_wafer_of_many_defects_has_a_band(fab):
    tables = loaded(fab)
    spark = tables["defects"].sparkSession
    tables["defects"] = spark.range(100_000).select(
        F.col("id").alias("defect_id"), F.lit(1).cast("long").alias("inspection_id"), F.lit(1).cast("long").alias("defect_type_id")
    )
    assert rows(correlation.yield_by_defect_band(tables))[1] == ("10+  (very high)", 1, Decimal("50.00"), Decimal("100000.00"))
