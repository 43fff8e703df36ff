"""Cumulative sums against a loop over the readings."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import START, rows, run, wafers
from waferscope.operators import drift, spc


def measured(number: int, tool: int, at, value: str, metric: str = "CD") -> dict:
    return {"measurement_id": number, "process_run_id": tool, "metric_type": metric, "value": Decimal(value), "measured_at": at}


def series(fab, readings: list[dict]):
    """Run 1 is on tool 1, run 2 on tool 2."""
    return fab(wafers=wafers(1, 2), process_runs=[run(1, 1, 1), run(2, 2, 3)], metrology_measurements=readings)


def looped(readings: list[dict], center: int, sigma: int) -> dict[int, tuple[int, int]]:
    """Upper and lower sums by measurement, centre and sigma in ten-thousandths."""
    made, high, low = {}, defaultdict(int), defaultdict(int)
    for r in sorted(readings, key=lambda r: (r["measured_at"], r["measurement_id"], r["value"])):
        away = 2 * (int(r["value"] * 10_000) - center)
        tool = r["process_run_id"]
        high[tool] = max(0, high[tool] + away - sigma)
        low[tool] = max(0, low[tool] - away - sigma)
        made[r["measurement_id"]] = (high[tool], low[tool])
    return made


@pytest.mark.parametrize("gap", [timedelta(seconds=7), timedelta(minutes=11), timedelta(hours=9), timedelta(0)])
def test_sums_equal_a_loop_whatever_the_times(fab, gap):
    rng = random.Random(3)
    readings = []
    for n in range(300):
        # Two thirds on the first tool, which drifts up, then down.
        tool = 1 if n % 3 else 2
        drifted = 0.8 if 100 < n < 180 else -0.6 if n > 240 else 0
        readings.append(measured(n, tool, START + n * gap, f"{rng.gauss(45 + drifted * (tool == 1), 1):.4f}"))
    tables = series(fab, readings)
    limits = spc.metric_limits(tables).first()
    center, sigma = int(limits.center_line * 10_000), int(limits.sigma * 10_000)
    found = {r.measurement_id: (r.sum_high, r.sum_low) for r in drift.cusum_points(tables).collect()}
    assert found == looped(readings, center, sigma)
    by_tool = {r.tool_code: r for r in drift.cusum_by_tool(tables, alarm=4).collect()}
    for tool, code in ((1, "E1"), (2, "E2")):
        own = [found[r["measurement_id"]] for r in readings if r["process_run_id"] == tool]
        over = [sum(s[side] > 8 * sigma for s in own) for side in (0, 1)]
        row = by_tool[code]
        assert (row.readings, row.alarms_high, row.alarms_low) == (len(own), *over)
        assert row.highest_high == Decimal(max(s[0] for s in own)) / 20_000
    assert by_tool["E1"].alarms_high > 0


def test_a_small_shift_is_seen_that_single_readings_do_not_show(fab):
    rng = random.Random(1)
    readings = [measured(n, 1, START + timedelta(hours=n), f"{rng.uniform(-1, 1) + (n >= 200) * 0.5:.4f}") for n in range(300)]
    tables = series(fab, readings)
    assert rows(spc.spc_limits(tables))[0][6] == 0
    (row,) = drift.cusum_by_tool(tables).collect()
    assert row.alarms_high > 20 and row.first_high >= (START + timedelta(hours=200)).date()


def test_readings_that_cannot_be_placed(fab):
    readings = [measured(1, 1, START, "1"), measured(2, 1, None, "9"), {**measured(3, 1, START, "1"), "value": None}, measured(4, 9, START, "5"), measured(5, 1, START, "3")]
    assert sorted(r.measurement_id for r in drift.cusum_points(series(fab, readings)).collect()) == [1, 5]
    assert drift.cusum_by_tool(series(fab, [measured(1, 1, START, "1", "alone")])).count() == 0
    assert drift.cusum_by_tool(series(fab, [])).count() == 0


def test_no_task_orders_more_than_a_minute_of_readings(fab, spark):
    """A tool's day with most of all readings is ordered minute by minute."""
    tables = series(fab, [measured(n, 1, START + timedelta(seconds=20 * n), "1.5" if n % 2 else "1") for n in range(600)])
    plan = drift.cusum_points(tables)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "measurement_id" in line]
    assert windows and all("minute" in line for line in windows)
