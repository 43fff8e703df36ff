from decimal import Decimal

from conftest import dies, rows, run, wafers
from waferscope.operators.cohort import Suspect
from waferscope.plans import conclusions, load_checks, views
from waferscope.plans.conclusions import MetricLimit

def suspect():
    return Suspect.named("E1", "A")



def test_row_counts_against_expectations(fab):
    found = rows(load_checks.row_count_check(fab(), {"tools": 3, "lots": 2}))
    assert found == [("lots", 2, 1, "**MISMATCH**"), ("tools", 3, 3, "OK")]


def headers_and_rows(fab, first, second):
    return fab(
        wafers=wafers(1, 2),
        defect_inspections=[{"wafer_id": 1, "defect_count": first}, {"wafer_id": 2, "defect_count": second}],
        defects=[{"inspection_id": i, "defect_type_id": 1} for i in (1, 1, 2)],
    )


def test_totals_that_cancel_are_caught_per_inspection(fab):
    good, cancelling, wrong = (headers_and_rows(fab, *c) for c in ((2, 1), (1, 2), (2, 2)))
    assert rows(load_checks.defect_reconcile(good)) == [("defects", 3, 3, "OK (rows = sum of counts)")]
    assert load_checks.unreconciled_inspections(good).count() == 0
    assert rows(load_checks.defect_reconcile(cancelling))[0][3] == "OK (rows = sum of counts)"
    assert sorted(rows(load_checks.unreconciled_inspections(cancelling))) == [(1, 1, 2), (2, 2, 1)]
    assert rows(load_checks.defect_reconcile(wrong))[0][3] == "**MISMATCH**"


def test_wrong_die_counts_are_listed(fab):
    tables = fab(wafers=wafers(1, 2, 3), bin_results=dies(1, 2, 0) + dies(2, 1, 0))
    assert sorted(rows(load_checks.die_grid_check(tables, 2))) == [(2, 1), (3, 0)]


def test_dies_of_unknown_wafers_are_listed(fab):
    tables = fab(wafers=wafers(1), bin_results=dies(1, 2, 0) + dies(9, 2, 0))
    assert rows(load_checks.die_grid_check(tables, 2)) == [(9, 2)]


def test_metrology_count(fab):
    tables = fab(metrology_measurements=[{"process_run_id": 1, "value": Decimal(1)}])
    assert rows(load_checks.metrology_count_check(tables, 2))[0][1:] == (1, 2, "**CHECK**")


def signal_tables(fab, high="2.0"):
    return fab(
        wafers=wafers(1, 2, 3),
        bin_results=dies(1, 1, 2) + dies(2, 2, 1) + dies(3, 1, 0),
        process_runs=[run(1, 1, 1), run(2, 2, 3), run(3, 2, 3)],
        defect_inspections=[{"wafer_id": 1, "defect_count": 8}, {"wafer_id": 2, "defect_count": 1}],
        defects=[{"inspection_id": 1, "defect_type_id": 1}] * 8 + [{"inspection_id": 2, "defect_type_id": 2}],
        metrology_measurements=[
            {"process_run_id": 1, "value": Decimal(high)},
            {"process_run_id": 2, "value": Decimal("1.0")},
            {"process_run_id": 3, "value": Decimal("0.0")},
        ],
    )


def test_signals(fab):
    tables = signal_tables(fab)
    assert sorted(rows(load_checks.signal_defects(tables, suspect()))) == [
        ("B1 defect_count", "E1/A", 1, Decimal("8.00")),
        ("B1 defect_count", "others", 1, Decimal("1.00")),
    ]
    assert sorted(rows(load_checks.signal_yield(tables, suspect()))) == [
        ("B2 die_yield_pct", "E1/A", 1, Decimal("33.33")),
        ("B2 die_yield_pct", "others", 2, Decimal("83.33")),
    ]
    assert rows(load_checks.signal_metrology(tables, suspect())) == [
        ("B3 CD", "E1/A", 1, Decimal("2.000")),
        ("B3 CD", "others", 2, Decimal("0.500")),
    ]


LIMITS = (MetricLimit("drifts", "CD", "0.5", True), MetricLimit("steady", "CD", "0.5", False), MetricLimit("absent", "Z", "1", True))


def test_conclusions_hold_for_a_real_suspect(fab):
    found = rows(conclusions.conclusion_report(signal_tables(fab), suspect(), LIMITS))
    assert found == [
        ("B1 yield: product spread flat", Decimal("0.000"), "PASS"),
        ("B1 yield: E1 trails peers", Decimal("33.330"), "PASS"),
        ("drifts", Decimal("1.500"), "PASS"),
        ("steady", Decimal("1.500"), "**CHECK**"),
        ("absent", None, "**CHECK**"),
        ("B4 commonality: E1/A is worst chamber", Decimal("1.000"), "PASS"),
        ("B5 correlation: high-defect band yields less", Decimal("50.010"), "PASS"),
    ]


def test_conclusions_fail_for_a_wrong_suspect(fab):
    found = rows(conclusions.conclusion_report(signal_tables(fab), Suspect.named("E2", "A"), LIMITS))
    assert [r[2] for r in found][1:3] == ["**CHECK**", "**CHECK**"]
    assert found[5][1:] == (Decimal("2.000"), "**CHECK**")


def test_pareto_closes_and_types_over_index(fab):
    found = rows(conclusions.check_pareto(signal_tables(fab), suspect()))
    assert [r[1:] for r in found] == [
        (Decimal("100.000"), "PASS"),
        (Decimal("100.000"), "PASS"),
        (Decimal("-100.000"), "**CHECK**"),
    ]


def test_view_totals_and_views(spark, fab):
    tables = signal_tables(fab)
    assert rows(conclusions.view_totals_check(tables, 3)) == [(3, 3, 9, "PASS")]
    assert rows(conclusions.view_totals_check(tables, 4))[0][3] == "**CHECK**"
    views.register_views(tables)
    assert sorted(rows(views.views_check(spark))) == [("v_wafer_defects", "PASS", 3), ("v_wafer_yield", "PASS", 3)]
    joined = spark.sql(
        "SELECT w.wafer_id, y.yield_pct, d.defect_count FROM wafers w "
        "JOIN v_wafer_yield y ON y.wafer_id = w.wafer_id JOIN v_wafer_defects d ON d.wafer_id = w.wafer_id"
    )
    assert (1, Decimal("33.33"), 8) in rows(joined)
    for name in [*tables, *views.BASE_VIEWS]:
        spark.catalog.dropTempView(name)
    assert {r[1] for r in rows(views.views_check(spark))} == {"**CHECK**"}
