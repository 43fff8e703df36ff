"""Rank sums and false discoveries against a direct computation."""

from __future__ import annotations

import math
import random

import pytest
from conftest import dies, run, wafers
from excursion import bind_excursion
from pyspark.sql import functions as F
from waferscope.operators import significance
from waferscope.operators.commonality import commonality_rank


def direct(own: list[int], others: list[int]) -> float | None:
    """The tie-corrected rank-sum score, by comparing every pair."""
    wins = sum((a > b) + 0.5 * (a == b) for a in own for b in others)
    n, m = len(own), len(others)
    whole = own + others
    ties = sum(whole.count(v) ** 3 - whole.count(v) for v in set(whole))
    spread = n * m / 12 * (n + m + 1 - ties / ((n + m) * (n + m - 1))) if n + m > 1 else 0
    return (wins - n * m / 2) / math.sqrt(spread) if spread > 0 else None


def discoveries(chances: list[float]) -> list[float]:
    """Adjusted chances of all places, worst first."""
    order = sorted(range(len(chances)), key=lambda i: chances[i])
    made, least = [0.0] * len(chances), 1.0
    for rank in range(len(order), 0, -1):
        least = min(least, chances[order[rank - 1]] * len(chances) / rank)
        made[order[rank - 1]] = least
    return made


def test_scores_equal_a_direct_computation(fab):
    rng = random.Random(4)
    failed = {w: rng.randrange(6) + (4 if w % 5 == 0 else 0) for w in range(1, 121)}
    paths = {w: [(1, 1 if w % 5 == 0 else 2), (3, 4) if rng.random() < 0.5 else (2, None)] for w in failed}
    tables = fab(
        wafers=wafers(*paths),
        process_runs=[run(w, tool, chamber, step) for w, path in paths.items() for step, (tool, chamber) in enumerate(path * 2, 1)],
        bin_results=[die for w in paths for die in dies(w, 40 - failed[w], failed[w])],
    )
    names = {(1, 1): ("E1", "A"), (1, 2): ("E1", "B"), (3, 4): ("D1", "A"), (2, None): ("E2", None)}
    scores = {}
    for place, name in names.items():
        through = {w for w, path in paths.items() if place in path}
        scores[name] = direct([-failed[w] for w in through], [-failed[w] for w in paths if w not in through])
    chances = {name: math.erfc(abs(round(z, 3)) / math.sqrt(2)) for name, z in scores.items()}
    adjusted = dict(zip(chances, discoveries(list(chances.values())), strict=True))
    found = {(r.tool_code, r.chamber_code): r for r in significance.chamber_significance(tables).collect()}
    assert set(found) == set(names.values())
    for name, row in found.items():
        assert float(row.rank_z) == pytest.approx(scores[name], abs=6e-4)
        assert float(row.p_value) == pytest.approx(chances[name], rel=1e-6, abs=2e-9)
        assert float(row.q_value) == pytest.approx(adjusted[name], rel=1e-6, abs=2e-9)


def test_chances_of_any_score(spark):
    scores = [0.0, 0.5, 1.0, 1.96, 3.0, 6.0, 12.0, 30.0, 38.0]
    df = spark.createDataFrame([(s,) for s in scores], "z double")
    for row in df.select("z", significance.two_sided(F.col("z")).alias("p")).collect():
        assert row.p == pytest.approx(math.erfc(row.z / math.sqrt(2)), rel=2e-7)


def test_nothing_to_compare(fab):
    equal = fab(wafers=wafers(1, 2, 3), process_runs=[run(w, 1, 1 + w % 2) for w in (1, 2, 3)], bin_results=[d for w in (1, 2, 3) for d in dies(w, 3, 1)])
    assert {(r.rank_z, r.p_value, r.q_value) for r in significance.chamber_significance(equal).collect()} == {(None, None, None)}
    assert significance.chamber_significance(fab()).count() == 0


def test_the_planted_chamber_is_the_surest(spark, star_folder):
    tables = bind_excursion(spark, star_folder, independent_modules=True)
    rows = significance.chamber_significance(tables).collect()
    assert (rows[0].tool_code, rows[0].chamber_code) == ("ETCH-02", "C") and rows[0].q_value < 1e-6
    low = [r for r in rows if r.rank_z is not None and r.rank_z < 0 and r.q_value < 0.001]
    assert len(low) == 1
    assert commonality_rank(tables).first().wafers_through == rows[0].wafers_through
