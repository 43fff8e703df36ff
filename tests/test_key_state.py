"""Loads audited one by one against an audit of everything."""

from __future__ import annotations

import re

import pytest
from conftest import rows, run, wafers
from pyspark.sql import functions as F
from waferscope.plans import audits, key_state


def full(tables) -> dict[tuple, int]:
    keys = [*audits.pk_audit(tables).collect(), *audits.unique_audit(tables).collect()]
    found = {(r.table_name, r.key, None): r.bad_rows for r in keys}
    links = {(*r.fk_name.split(".", 1), r.parent_table): r.orphans for r in audits.fk_audit(tables).collect()}
    return found | links


def reported(spark, root: str, number: int | None = None) -> dict[tuple, int]:
    return {(r.table_name, r.key, r.parent_table): r.bad for r in key_state.key_report(spark, root, number).collect()}


def damaged(fab):
    """Surplus and missing keys, orphans, and a chamber that most runs name."""
    made = wafers(*range(1, 41), 7, 7, 8) + [{"wafer_id": None, "wafer_scribe": None}, {"wafer_id": 50, "wafer_scribe": "W3", "lot_id": 9}]
    runs = [run(w % 45, 1 if w % 9 else 77, 1 if w % 3 else None) for w in range(120)]
    return fab(wafers=made, process_runs=runs)


def parts(tables, count: int) -> list[dict]:
    """The tables dealt over loads by a hash of whole rows, so that children may come before their parents."""
    number = lambda df: F.pmod(F.xxhash64(*df.columns), F.lit(count))
    return [{name: df.filter(number(df) == n) for name, df in tables.items()} for n in range(count)]


@pytest.mark.parametrize("count", [1, 4])
def test_loads_one_by_one_equal_a_full_audit(fab, spark, tmp_path, count):
    tables, root = damaged(fab), str(tmp_path)
    wanted = full(tables)
    assert sum(bool(n) for n in wanted.values()) >= 4
    for number, part in enumerate(parts(tables, count), start=1):
        assert key_state.audit_load(part, root, buckets=8) == number
    assert reported(spark, root) == wanted
    loaded = {(r.table_name, r.key): r.rows for r in key_state.key_report(spark, root).collect()}
    assert loaded["wafers", "wafer_id"] == 45 and loaded["process_runs", "chamber_id"] == 120


def test_an_orphan_is_one_until_its_parent_comes(fab, spark, tmp_path):
    root, tables = str(tmp_path), fab(wafers=wafers(1, 2))
    key_state.audit_load({"wafers": tables["wafers"]}, root, buckets=4)
    link = ("wafers", "lot_id", "lots")
    assert reported(spark, root)[link] == 2
    key_state.audit_load({"lots": tables["lots"]}, root)
    assert (reported(spark, root)[link], reported(spark, root, 1)[link]) == (0, 2)


def test_merged_runs_go_on_with_the_same_counts(fab, spark, tmp_path):
    root, loads = str(tmp_path), parts(damaged(fab), 3)
    for part in loads[:2]:
        key_state.audit_load(part, root, buckets=8)
    before = reported(spark, root)
    assert key_state.merge_runs(spark, root) == 3 and reported(spark, root) == before
    assert len(key_state._state(spark, root).inputFiles()) <= 8
    key_state.audit_load(loads[2], root)
    assert reported(spark, root) == full(damaged(fab))


def test_a_load_reads_only_the_buckets_of_its_keys(fab, spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    key_state.audit_load(fab(wafers=wafers(*range(1, 200))), root, buckets=64)
    read = []
    sums = key_state._sums
    monkeypatch.setattr(key_state, "_sums", lambda runs, new: read.append(runs) or sums(runs, new))
    key_state.audit_load({"lots": fab(lots=[{"lot_id": 500, "lot_number": "L500"}])["lots"]}, root)
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[[^\]]*bucket#\d+ IN \(([^)]*)\)", plan)
    assert filters and len(filters[0].split(",")) <= 2


def test_a_load_that_fails_changes_nothing(fab, spark, tmp_path):
    root = str(tmp_path)
    key_state.audit_load(fab(wafers=wafers(1, 2)), root, buckets=4)
    before = reported(spark, root)
    broken = {"wafers": fab(wafers=wafers(5))["wafers"].withColumn("wafer_id", F.raise_error(F.lit("lost")).cast("long"))}
    with pytest.raises(Exception, match="lost"):
        key_state.audit_load(broken, root)
    assert reported(spark, root) == before
    assert key_state.audit_load({"wafers": fab(wafers=wafers(2))["wafers"]}, root) == 2
    assert reported(spark, root)["wafers", "wafer_id", None] == 1


def test_loads_that_say_nothing(fab, spark, tmp_path):
    root = str(tmp_path)
    assert rows(key_state.key_report(spark, root)) == []
    with pytest.raises(ValueError, match="nothing was loaded"):
        key_state.merge_runs(spark, root)
    assert key_state.audit_load({"notes": spark.range(3)}, root) == 1
    assert {r.bad for r in key_state.key_report(spark, root).collect()} == {0}


def test_earlier_runs_meet_a_load_without_being_moved(fab, spark, tmp_path, monkeypatch):
    """Counts are moved once, when a load's entries are counted; runs are dealt to files alike and meet where they lie."""
    made, sums, root = [], key_state._sums, str(tmp_path)
    monkeypatch.setattr(key_state, "_sums", lambda *given: made.append(sums(*given)) or made[-1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for part in parts(damaged(fab), 3):
            key_state.audit_load(part, root, buckets=4)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in made]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [plan.count("FileScan parquet") for plan in plans] == [1, 2, 3] and not any("Exchange" in plan for plan in plans)
    # A session that knows none of the runs, with another number of shuffle partitions.
    for table in spark.catalog.listTables():
        if table.name.startswith("key_run_"):
            spark.sql(f"DROP TABLE {table.name}")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        key_state.audit_load(damaged(fab), root)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    twice = {name: df.unionByName(df) for name, df in damaged(fab).items()}
    assert reported(spark, root) == full(twice)


def test_whole_numbers_are_the_same_key_as_text_and_as_numbers(spark, tmp_path):
    wafers = spark.createDataFrame([(n,) for n in (0, 7, -7, 2**63 - 1, -(2**63), 10**18)], "wafer_id bigint")
    texts = ["0", "7", "-7", str(2**63 - 1), str(-(2**63)), str(10**18), "07", " 7", "+7", "-0", "7.0", str(2**63), "W7", "", None]
    runs = spark.createDataFrame([(t,) for t in texts], "wafer_id string")
    tables = {"wafers": wafers, "process_runs": runs}
    assert {r.fk_name: r.orphans for r in audits.fk_audit(tables).collect()}["process_runs.wafer_id"] == 8
    key_state.audit_load({"process_runs": runs}, str(tmp_path))
    key_state.audit_load({"wafers": wafers}, str(tmp_path))
    assert reported(spark, str(tmp_path))["process_runs", "wafer_id", "wafers"] == 8


def test_runs_of_the_earlier_layout_are_refused(fab, spark, tmp_path):
    old = key_state._RUNS_DDL.replace("files int, ", "")
    rows = [(1, "run-1", False, 4, q.number, 0, 0) for q in key_state.QUESTIONS]
    spark.createDataFrame(rows, old).write.parquet(f"{tmp_path}/{key_state.RUNS}")
    with pytest.raises(ValueError, match="earlier layout"):
        key_state.audit_load(fab(wafers=wafers(1)), str(tmp_path))
