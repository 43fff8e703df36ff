"""The labelled excursion: the analyses must find the chamber that was made bad."""

from __future__ import annotations

import pytest
from conftest import rows
from waferscope.operators.commonality import commonality_rank, find_suspect, suspect_vs_peers
from waferscope.operators.correlation import cohort_fingerprint
from waferscope.operators.spc import spc_by_tool, spc_limits
from waferscope.plans import conclusions, load_checks
from waferscope.plans.audits import contract_summary
from waferscope.plans.investigation import investigate
from excursion import bind_excursion, known_suspect
from waferscope.sources.parquet import read_fab, write_fab


@pytest.fixture(scope="module")
def excursion(spark, star_folder, tmp_path_factory):
    """Written and read back, so that the round trip is tested too."""
    folder = str(tmp_path_factory.mktemp("fab"))
    write_fab(bind_excursion(spark, star_folder), folder)
    return read_fab(spark, folder)


def test_the_load_is_complete(excursion):
    expected = {
        "tools": 13,
        "process_steps": 10,
        "defect_types": 8,
        "bin_codes": 8,
        "chambers": 14,
        "lots": 60,
        "wafers": 1500,
        "process_runs": 15000,
        "defect_inspections": 1500,
        "bin_results": 216000,
    }
    assert {r[3] for r in rows(load_checks.row_count_check(excursion, expected))} == {"OK"}
    assert rows(load_checks.defect_reconcile(excursion))[0][3].startswith("OK")
    assert load_checks.unreconciled_inspections(excursion).count() == 0
    assert rows(load_checks.metrology_count_check(excursion, 6000))[0][3] == "OK"
    assert load_checks.die_grid_check(excursion, 144).count() == 0
    assert {r.violations for r in contract_summary(excursion).collect()} == {0}


def test_the_bad_chamber_is_found_without_being_named(excursion):
    found = find_suspect(excursion).first()
    assert (found.tool_code, found.chamber_code, found.wafers_through) == ("ETCH-02", "C", 187)
    assert 83.5 < float(found.avg_yield_pct) < 84.8


def test_its_siblings_and_peers_are_healthy(excursion):
    suspect, peers = rows(suspect_vs_peers(excursion, known_suspect(), "Etcher", "Other etch chambers"))
    assert (suspect[0], suspect[1]) == ("Suspect: ETCH-02/C", 187)
    assert (peers[0], peers[1]) == ("Other etch chambers", 1313)
    assert 5.5 < float(peers[2] - suspect[2]) < 6.5
    assert suspect[4] > peers[3], "ranges overlap"


def test_every_conclusion_holds(excursion):
    report = conclusions.conclusion_report(excursion, known_suspect())
    assert [r[2] for r in rows(report)] == ["PASS"] * 7
    assert [r[2] for r in rows(conclusions.check_pareto(excursion, known_suspect()))] == ["PASS"] * 3
    assert rows(conclusions.view_totals_check(excursion, 1500))[0][3] == "PASS"


def test_stored_measures_give_the_same_report(excursion, tmp_path):
    from waferscope.sources.parquet import with_measures

    stored = with_measures(excursion, str(tmp_path))
    report = conclusions.conclusion_report(stored, known_suspect())
    assert rows(report) == rows(conclusions.conclusion_report(excursion, known_suspect()))
    assert "bin_results" not in commonality_rank(stored)._jdf.queryExecution().executedPlan().toString()


def test_the_bad_chamber_drifts_and_its_readings_run_on_one_side(excursion):
    from waferscope.operators.spc import spc_by_chamber

    assert rows(spc_by_chamber(excursion))[0][:2] == ("ETCH-02", "C")


def test_fingerprint_and_limits_are_in_the_published_bands(excursion):
    bad, others = rows(cohort_fingerprint(excursion, known_suspect()))
    assert (bad[0], others[0]) == ("ETCH-02/C (bad)", "All others")
    assert 5.8 < float(bad[3]) < 6.4 and 3.8 < float(others[3]) < 4.2
    assert 66 < float(bad[4]) < 76 and 22 < float(others[4]) < 26
    assert {r[6] for r in rows(spc_limits(excursion))} == {0}


def test_independent_dealing_leaves_no_second_suspect(spark, star_folder):
    tables = bind_excursion(spark, star_folder, independent_modules=True)
    ranked = rows(commonality_rank(tables))
    assert ranked[0][:2] == ("ETCH-02", "C")
    # Dealt by the same counter, some deposition chambers trail by 1.5 points; dealt apart, none does.
    assert min(float(r[3]) for r in ranked[1:]) > 89.0
    centres = [float(r[2]) for r in rows(spc_by_tool(tables))]
    assert max(centres) - min(centres) < 0.1


def test_investigation_lists_every_analysis(excursion):
    results = investigate(excursion)
    assert list(results)[7] == "commonality_rank"
    assert len(results) == 19
    assert results["cohort_fingerprint"].columns[0] == "grp"
