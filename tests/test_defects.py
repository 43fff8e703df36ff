from decimal import Decimal

from conftest import rows, run, wafers
from waferscope.operators import defects
from waferscope.operators.cohort import Suspect


def inspection(wafer, count=0, number=None):
    return {"inspection_id": number or wafer, "wafer_id": wafer, "defect_count": count}


def defect(inspection_id, kind):
    return {"inspection_id": inspection_id, "defect_type_id": kind}


def test_clean_wafers_are_kept_with_zero(fab):
    tables = fab(
        wafers=wafers(1, 2, 3),
        defect_inspections=[inspection(1, 2), inspection(2, 0), inspection(1, 1, number=9)],
        defects=[defect(1, 1), defect(1, 2), defect(9, 1)],
    )
    assert dict(rows(defects.wafer_defects(tables))) == {1: 3, 2: 0, 3: 0}


def test_pareto_closes_and_orders_ties_by_name(fab):
    tables = fab(defects=[defect(1, 1), defect(1, 3), defect(1, 3), defect(1, 2)])
    assert [(r[0], r[3], r[4], r[5]) for r in rows(defects.defect_pareto(tables))] == [
        ("Void", 2, Decimal("50.00"), Decimal("50.00")),
        ("Flake", 1, Decimal("25.00"), Decimal("75.00")),
        ("Particle", 1, Decimal("25.00"), Decimal("100.00")),
    ]


def mix_tables(fab):
    return fab(
        wafers=wafers(1, 2),
        process_runs=[run(1, 1, 1), run(1, 1, 1, step=2), run(2, 1, 2)],
        defect_inspections=[inspection(1, 3), inspection(2, 2)],
        defects=[defect(1, 1), defect(1, 1), defect(1, 2), defect(2, 3), defect(2, 1)],
    )


def test_mix_is_a_share_within_each_group(fab):
    found = rows(defects.defect_mix_by_cohort(mix_tables(fab), Suspect.named("E1", "A")))
    assert found == [
        ("Particle", Decimal("66.67"), Decimal("50.00")),
        ("Flake", Decimal("33.33"), Decimal("0.00")),
        ("Void", Decimal("0.00"), Decimal("50.00")),
    ]


def test_mix_of_an_empty_cohort_is_null_not_an_error(fab):
    found = rows(defects.defect_mix_by_cohort(mix_tables(fab), Suspect.named("E2", "A")))
    assert {r[1] for r in found} == {None}
    assert sum(r[2] for r in found) == Decimal("100.00")
