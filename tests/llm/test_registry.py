"""Registered queries with SQL against DuckDB, and that each is there."""

from __future__ import annotations

import glob
from pathlib import Path

import duckdb
import pytest
from waferscope.llm.registry import oracle_sql, queries

QUERIES = queries()


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_its_sql(name, spark, star_folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{star_folder}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    found = connection.execute(oracle_sql()[name])
    columns = [c[0] for c in found.description]
    df = QUERIES[name](spark, star_folder)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, found.fetchall()))
    if name == "op2_chat":
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
