"""Readers and writers."""

from __future__ import annotations

import pytest
from conftest import dies, rows, run, wafers
from waferscope.operators.commonality import commonality_rank
from waferscope.sources.contract import TABLES, conform
from excursion import bind_excursion
from waferscope.sources.parquet import read_fab, save_tables, saved_tables, write_fab


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def saved(spark):
    yield lambda: saved_tables(spark)
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS default.{name}")


def test_bucketed_facts_meet_without_a_shuffle_by_wafer(spark, star_folder, tmp_path, saved):
    source = bind_excursion(spark, star_folder)
    spark.range(1).createOrReplaceTempView("bin_results")  # must not be mistaken for the table
    save_tables(source, str(tmp_path), buckets=4)
    ranked = commonality_rank(saved())
    assert rows(ranked) == rows(commonality_rank(source))
    assert "hashpartitioning(wafer_id" not in final_plan(ranked)
    spark.catalog.dropTempView("bin_results")


def test_facts_named_as_uneven_are_not_bucketed(fab, tmp_path, saved, spark):
    tables = fab(
        wafers=wafers(*range(1, 9)),
        bin_results=dies(1, 60, 0) + [d for w in range(2, 9) for d in dies(w, 1, 1)],
        process_runs=[run(w, 1, 1) for w in range(1, 9)],
    )
    save_tables(tables, str(tmp_path), buckets=4, spread={"bin_results"})
    buckets = {
        name: [r.data_type for r in spark.sql(f"DESCRIBE FORMATTED default.{name}").collect() if r.col_name == "Num Buckets"]
        for name in ("bin_results", "process_runs")
    }
    assert buckets == {"bin_results": [], "process_runs": ["4"]}
    assert sorted(rows(saved()["bin_results"])) == sorted(rows(conform(tables["bin_results"], "bin_results")))


def test_a_refresh_replaces_everything(fab, tmp_path, spark):
    folder = str(tmp_path)
    write_fab(fab(wafers=wafers(1, 2, 3)), folder)
    write_fab(fab(wafers=wafers(4)), folder)
    assert [r[0] for r in rows(read_fab(spark, folder)["wafers"])] == [4]


def test_missing_required_columns_are_refused(spark):
    with pytest.raises(ValueError, match="tool_code"):
        conform(spark.createDataFrame([(1,)], "tool_id int"), "tools")
