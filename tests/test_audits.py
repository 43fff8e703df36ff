from datetime import date
from decimal import Decimal

from conftest import dies, rows, run, wafers
from waferscope.plans import audits
from waferscope.sources.contract import TABLES


def test_contract_size():
    tables = TABLES.values()
    assert len(tables) == 12
    assert sum(len(t.links) for t in tables) == 13
    assert sum(len(t.unique) for t in tables) == 9
    assert sum(len(t.rules) for t in tables) == 4
    assert sum(f.default is not None for t in tables for f in t.fields) == 9


def clean(fab):
    return fab(
        lots=[{"lot_number": "L1", "start_date": date(2024, 1, 1)}],
        wafers=wafers(1, 2),
        process_runs=[run(1, 1, 1), run(2, 1, None)],
        bin_results=dies(1, 1, 1),
        defect_inspections=[{"wafer_id": 1, "defect_count": 1}],
        defects=[{"inspection_id": 1, "defect_type_id": 1, "defect_size_um": Decimal("0.1")}],
        metrology_measurements=[{"process_run_id": 1, "value": Decimal(1), "spec_low": None, "spec_high": Decimal(2)}],
    )


def test_clean_tables_have_no_violations(fab):
    summary = {r.table_name: r for r in audits.contract_summary(clean(fab)).collect()}
    assert len(summary) == 13
    assert summary["(all)"][1:3] == (12, 13)
    assert summary["(all)"].rows == sum(r.rows for name, r in summary.items() if name != "(all)")
    assert {r.violations for r in summary.values()} == {0}


def broken(fab):
    """One violation of each kind."""
    twice = {"wafer_id": 3, "wafer_scribe": "W3", "lot_id": 9, "slot_no": 26}
    return {
        **clean(fab),
        "wafers": fab(wafers=[*wafers(1, 2), twice, {**twice, "wafer_scribe": "x" * 31}])["wafers"],
        "bin_results": fab(bin_results=dies(1, 1, 1) + [{"bin_result_id": 7, "wafer_id": 1, "bin_code_id": 1, "die_x": 0, "die_y": 1}])["bin_results"],
        "defect_inspections": fab(defect_inspections=[{"wafer_id": 1, "defect_count": -1}, {"wafer_id": None}])["defect_inspections"],
        "defects": fab(defects=[{"inspection_id": 1, "defect_type_id": 1, "defect_size_um": Decimal("-1")}, {"inspection_id": 77, "defect_type_id": 1}])["defects"],
        "metrology_measurements": fab(
            metrology_measurements=[{"process_run_id": 1, "value": Decimal(1), "spec_low": Decimal(3), "spec_high": Decimal(2)}]
        )["metrology_measurements"],
    }


def test_each_audit_counts_its_violation(fab):
    tables = broken(fab)
    assert {r[0]: r[2] for r in rows(audits.pk_audit(tables)) if r[2]} == {"wafers": 1}
    assert {(r[0], r[1]): r[2] for r in rows(audits.unique_audit(tables)) if r[2]} == {
        ("wafers", "lot_id, slot_no"): 1,
        ("bin_results", "wafer_id, die_x, die_y"): 1,
    }
    assert {r[0]: r[3] for r in rows(audits.fk_audit(tables)) if r[3]} == {
        "wafers.lot_id": 2,
        "defects.inspection_id": 1,
    }
    assert {r[0]: r[2] for r in rows(audits.check_audit(tables)) if r[2]} == {
        "slot_in_cassette": 2,
        "count_not_negative": 1,
        "spec_limits_ordered": 1,
        "size_not_negative": 1,
    }
    found = {(r[0], r[1]): r[3:] for r in rows(audits.not_null_audit(tables)) if r[3] or r[4]}
    assert found == {("wafers", "wafer_scribe"): (0, 1), ("defect_inspections", "wafer_id"): (1, 0)}


def test_links_are_listed_with_their_use(fab):
    links = {r.fk_name: r.rows for r in audits.contract_links(clean(fab)).collect()}
    assert len(links) == 13 and links["process_runs.chamber_id"] == 1


def test_absent_tables_and_columns_are_violations(fab):
    tables = clean(fab)
    del tables["defects"], tables["tools"]
    tables["wafers"] = tables["wafers"].drop("slot_no")
    summary = {r.table_name: r for r in audits.contract_summary(tables).collect()}
    assert (summary["defects"].tables, summary["defects"].rows, summary["defects"].violations) == (0, None, 1)
    assert (summary["wafers"].violations, summary["wafers"].status) == (1, "**CHECK**")
    assert (summary["(all)"].tables, summary["(all)"].links, summary["(all)"].status) == (10, 8, "**CHECK**")
    assert summary["lots"].status == "PASS"
    assert {r.table_name: r.bad_rows for r in audits.pk_audit(tables).collect()}["defects"] is None
    assert {r.key: r.bad_rows for r in audits.unique_audit(tables).collect() if r.table_name == "wafers"} == {"wafer_scribe": 0, "lot_id, slot_no": None}
    orphans = {r.fk_name: r.orphans for r in audits.fk_audit(tables).collect()}
    assert len(orphans) == 13 and orphans["chambers.tool_id"] is None and orphans["wafers.lot_id"] == 0
    assert {r.check_name: r.violations for r in audits.check_audit(tables).collect()}["slot_in_cassette"] is None
    gaps = {(r.table_name, r.column): r.present for r in audits.not_null_audit(tables).collect()}
    assert gaps[("wafers", "slot_no")] is False and gaps[("defects", "defect_id")] is False and gaps[("lots", "lot_id")]
    assert {r.fk_name: r.rows for r in audits.contract_links(tables).collect()}["defects.inspection_id"] is None


def test_clean_summary_passes(fab):
    assert {r.status for r in audits.contract_summary(clean(fab)).collect()} == {"PASS"}
