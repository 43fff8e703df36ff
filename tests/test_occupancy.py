"""Overlapping runs against every pair of runs compared."""

from __future__ import annotations

import random
from datetime import timedelta

from conftest import START, rows, wafers
from waferscope.operators.occupancy import occupancy, overlapping_runs, run_sequence


def timed(number: int, chamber: int | None, tool: int, start, minutes: float | None) -> dict:
    end = None if start is None or minutes is None else start + timedelta(minutes=minutes)
    return {
        "process_run_id": number, "wafer_id": 1, "process_step_id": 1, "tool_id": tool, "chamber_id": chamber,
        "run_start": start, "run_end": end, "run_status": "Completed",
    }


def test_overlaps_equal_a_self_join(fab):
    rng = random.Random(2)
    runs = []
    for n in range(400):
        chamber = rng.choice([1, 1, 1, 1, 2, 3, None])
        # Some starts are equal; some runs last for days.
        start = START + timedelta(seconds=rng.choice([0, 30, 60]) + 60 * rng.randrange(3_000))
        runs.append(timed(n, chamber, {1: 1, 2: 1, 3: 2, None: 2}[chamber], start, rng.choice([0, 0.5, 2, 20, 4_000 if n % 90 == 0 else 5])))
    tables = fab(wafers=wafers(1), process_runs=runs)

    def place(r: dict) -> tuple:
        return (r["chamber_id"],) if r["chamber_id"] is not None else ("tool", r["tool_id"])

    latest, seconds = {}, {}
    for r in runs:
        before = [
            e for e in runs
            if place(e) == place(r) and (e["run_start"], e["process_run_id"]) < (r["run_start"], r["process_run_id"])
        ]
        latest[r["process_run_id"]] = max((e["run_end"] for e in before), default=None)
    found = {r.process_run_id: r.busy_until for r in run_sequence(tables).collect()}
    assert found == latest
    wanted = {r["process_run_id"] for r in runs if latest[r["process_run_id"]] and r["run_start"] < latest[r["process_run_id"]]}
    assert {r.process_run_id for r in overlapping_runs(tables).collect()} == wanted and wanted

    # Seconds in which at least one run was on, counted one by one.
    for r in runs:
        span = range(int((r["run_start"] - START).total_seconds()), int((r["run_end"] - START).total_seconds()))
        seconds.setdefault(place(r), set()).update(span)
    names = {(1,): ("E1", "A"), (2,): ("E1", "B"), (3,): ("E2", "A"), ("tool", 2): ("E2", None)}
    busy = {(r.tool_code, r.chamber_code): (r.runs, r.busy_seconds) for r in occupancy(tables).collect()}
    assert busy == {names[p]: (sum(place(r) == p for r in runs), len(s)) for p, s in seconds.items()}


def test_runs_that_cannot_be_placed(fab):
    runs = [timed(1, 1, 1, START, None), timed(2, 1, 1, START, -30), timed(3, 1, 9, START, 5), timed(4, 1, 1, START + timedelta(minutes=4), 1), timed(5, 99, 1, START, 5)]
    tables = fab(wafers=wafers(1), process_runs=runs)
    assert [r.process_run_id for r in overlapping_runs(tables).collect()] == [4]
    assert sorted(rows(occupancy(tables)), key=str) == [("E1", "A", 4, 1, 300), (None, None, 1, 0, 300)]
    assert overlapping_runs(fab()).count() == 0 and occupancy(fab()).count() == 0


def test_no_task_orders_more_than_a_minute_of_runs(fab):
    tables = fab(wafers=wafers(1), process_runs=[timed(n, 1, 1, START + timedelta(seconds=n), 1) for n in range(200)])
    plan = run_sequence(tables)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "process_run_id" in line]
    assert windows and all("minute" in line for line in windows)
