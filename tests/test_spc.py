from datetime import datetime, timedelta
from decimal import Decimal

from conftest import rows, run, wafers
from waferscope.operators import spc
from waferscope.operators.cohort import Suspect


def reading(run_id, value, metric="CD"):
    return {"process_run_id": run_id, "value": Decimal(value), "metric_type": metric}


def test_single_reading_has_no_sigma_and_nothing_out(fab):
    tables = fab(metrology_measurements=[reading(1, "5.0000", "Solo")])
    assert rows(spc.spc_limits(tables)) == [("Solo", 1, Decimal("5.0000"), None, None, None, 0)]


def test_limits_use_rounded_centre_and_sigma(fab):
    values = ["1.0000"] * 40 + ["9.0000"]
    tables = fab(metrology_measurements=[reading(1, v) for v in values])
    (found,) = rows(spc.spc_limits(tables))
    centre, sigma = found[2], found[3]
    assert (centre, sigma) == (Decimal("1.1951"), Decimal("1.2494"))
    assert found[4] == centre + 3 * sigma and found[5] == centre - 3 * sigma
    assert found[6] == 1


def test_a_reading_on_the_limit_is_inside(fab):
    # mean 0, sigma exactly 1: limits at +-3 with no reading beyond
    values = ["-1.0000", "1.0000"] * 4 + ["0.0000"]
    tables = fab(metrology_measurements=[reading(1, v) for v in values])
    (found,) = rows(spc.spc_limits(tables))
    assert (found[3], found[6]) == (Decimal("1.0000"), 0)
    points = spc.chart_points(tables, "CD").collect()
    assert len(points) == 9 and not any(p.is_out for p in points)


def shift_tables(fab):
    return fab(
        wafers=wafers(1, 2, 3),
        process_runs=[run(1, 1, 1), run(2, 1, 2), run(3, 2, 3)],
        metrology_measurements=[reading(1, "3.0000"), reading(2, "1.0000"), reading(3, "2.0000"), reading(3, "9", "X")],
    )


def test_group_shift_in_sigma_of_all_readings(fab):
    found = rows(spc.spc_group_shift(shift_tables(fab), Suspect.named("E1", "A"), "CD"))
    assert found == [
        ("E1/A", 1, Decimal("3.0000"), Decimal("2.0000"), Decimal("5.0000"), Decimal("1.000")),
        ("Others", 2, Decimal("1.5000"), Decimal("2.0000"), Decimal("5.0000"), Decimal("-0.500")),
    ]


def test_tool_of_a_reading_is_the_tool_of_its_run(fab):
    found = rows(spc.spc_by_tool(shift_tables(fab), "CD"))
    assert found == [
        ("E1", 2, Decimal("2.0000"), Decimal("1.4142")),
        ("E2", 1, Decimal("2.0000"), None),
    ]



def along(values, start=datetime(2024, 1, 1), step=timedelta(hours=5)):
    return [{**reading(1, str(v)), "measured_at": start + i * step, "measurement_id": i} for i, v in enumerate(values)]


def test_runs_go_on_over_days(fab):
    # centre 0: nine above, eight below, one on the line, seven above
    values = [1] * 9 + [-2] * 8 + [0] + [1] * 7
    tables = fab(wafers=wafers(1), process_runs=[run(1, 1, 1)], metrology_measurements=along(values))
    assert rows(spc.spc_run_rules(tables)) == [("E1", "CD", 25, 2, 17, 9)]
    assert rows(spc.spc_run_rules(tables, length=7)) == [("E1", "CD", 25, 3, 24, 9)]


def test_runs_do_not_depend_on_how_days_cut_them(fab):
    import random

    rng = random.Random(8)
    values = [rng.choice([-1, 1, 1]) for _ in range(120)]
    found = set()
    for hours in (1, 7, 24, 50):
        tables = fab(wafers=wafers(1), process_runs=[run(1, 1, 1)], metrology_measurements=along(values, step=timedelta(hours=hours)))
        found.add(rows(spc.spc_run_rules(tables, length=4))[0])
    centre, runs, last = sum(values) / len(values), [], None
    for v in values:
        side = v > centre
        runs = [*runs[:-1], runs[-1] + 1] if side == last else [*runs, 1]
        last = side
    long = [n for n in runs if n >= 4]
    assert found == {("E1", "CD", 120, len(long), sum(long), max(runs))}


def test_readings_count_for_every_chamber_their_wafer_ran_in(fab):
    tables = fab(
        wafers=wafers(1, 2),
        process_runs=[run(1, 1, 1), run(1, 2, 3), run(1, 1, 1), run(2, 1, 1), run(2, 1, None)],
        metrology_measurements=[reading(1, "1"), reading(4, "4")],
    )
    assert rows(spc.spc_by_chamber(tables)) == [
        ("E1", "A", 2, Decimal("2.5000"), Decimal("2.1213")),
        ("E2", "A", 1, Decimal("1.0000"), None),
    ]


def test_capability_uses_the_nearer_limit(fab):
    limits = {"spec_low": Decimal(-3), "spec_high": Decimal(9)}
    values = ["-1.0000", "1.0000"] * 4 + ["0.0000"]
    tables = fab(metrology_measurements=[{**reading(1, v), **limits} for v in values] + [reading(1, "5", "none")])
    assert rows(spc.capability(tables)) == [
        ("CD", Decimal("-3.0000"), Decimal("9.0000"), 9, 0, Decimal("0.00"), Decimal("2.000"), Decimal("1.000"))
    ]


def test_readings_must_have_the_asked_columns(fab):
    import pytest

    tables = fab()
    tables["metrology_readings"] = tables["metrology_measurements"]
    with pytest.raises(ValueError, match="tool_id"):
        spc.readings(tables, "tool_id")
