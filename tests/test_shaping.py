from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows, wafers
from pyspark.sql import functions as F
from waferscope.operators import shaping
from waferscope.operators.cohort import Suspect
from waferscope.sources import contract, lookups


def test_keys_resolve_by_code_and_leftovers_are_reported(spark):
    child = spark.createDataFrame([("ETCH-01", 1), ("NONE", 2)], "tool_code string, n int")
    parent = lookups.tools(spark)
    assert rows(shaping.resolve_keys(child, parent, "tool_code", "tool_id").select("n", "tool_id")) == [(1, 3)]
    assert rows(shaping.unresolved_keys(child, parent, "tool_code").select("n")) == [(2,)]


def test_series_lots_and_wafers(spark):
    numbers = spark.range(1, 61).withColumnRenamed("id", "n")
    lots = shaping.derive_lots(numbers)
    found = {r.n: r for r in lots.collect()}
    assert len(found) == 60
    assert found[1][1:] == ("LOT-24001", "GPU-B20", "5nm", 25, date(2024, 1, 2), "Completed")
    assert (found[60].lot_number, found[60].product, found[60].status) == ("LOT-24060", "SoC-A17", "In Process")
    made = shaping.derive_wafers(lots.withColumnRenamed("n", "lot_id")).collect()
    assert len(made) == 1500
    assert {w.wafer_scribe for w in made if w.lot_id == 1} >= {"LOT-24001.01", "LOT-24001.25"}


def test_start_dates_follow_the_lot_number_without_end(spark):
    lots = shaping.derive_lots(spark.createDataFrame([(36_500,), (40_000,)], "n long"))
    assert [r.start_date for r in lots.orderBy("n").collect()] == [date(2123, 12, 8), date(2133, 7, 8)]


def test_nodes_can_vary_independently_of_products(spark):
    lots = shaping.derive_lots(spark.range(1, 10).withColumnRenamed("id", "n"), node_stride=3)
    assert lots.select("product", "technology_node").distinct().count() == 9


def test_defaults_fill_only_nulls(spark):
    df = spark.createDataFrame([(None, "Scrapped"), (20, None)], "planned_qty int, status string")
    filled = shaping.apply_defaults(df, contract.default_columns(contract.TABLES["lots"]))
    assert rows(filled) == [(25, "Scrapped"), (20, "In Process")]


@pytest.fixture
def equipment(spark):
    chambers = shaping.resolve_keys(lookups.chamber_codes(spark), lookups.tools(spark), "tool_code", "tool_id")
    return {
        "tools": lookups.tools(spark),
        "chambers": chambers.select("chamber_id", "tool_id", "chamber_code"),
        "process_steps": lookups.process_steps(spark),
    }


MODULES = [
    shaping.ModuleTools("Lithography", ("Scanner",)),
    shaping.ModuleTools("Etch", ("Etcher",), by_chamber=True),
    shaping.ModuleTools("Deposition", ("Deposition",), by_chamber=True),
    shaping.ModuleTools("CMP", ("CMP",)),
    shaping.ModuleTools("Implant", ("Implant",)),
    shaping.ModuleTools("Metrology", ("Metrology", "CD-SEM")),
]


def test_catalog_numbers_options_by_code(equipment):
    catalog = shaping.assignment_catalog(equipment, MODULES).collect()
    sizes = {r.module: r.opt_count for r in catalog}
    assert sizes == {"Lithography": 2, "Etch": 8, "Deposition": 6, "CMP": 1, "Implant": 1, "Metrology": 2}
    for module, size in sizes.items():
        assert sorted(r.opt_no for r in catalog if r.module == module) == list(range(1, size + 1))
    sixth = next(r for r in catalog if r.module == "Etch" and r.opt_no == 6)
    assert (sixth.tool_id, sixth.chamber_id) == (4, 6)
    assert all((r.chamber_id is None) == (r.module not in ("Etch", "Deposition")) for r in catalog)


def route(spark, equipment, count=24):
    made = spark.createDataFrame([(w["wafer_id"], 1) for w in wafers(*range(1, count + 1))], "wafer_id long, lot_id int")
    lots = spark.createDataFrame([(1, date(2024, 1, 5))], "lot_id int, start_date date")
    catalog = shaping.assignment_catalog(equipment, MODULES)
    return shaping.expand_route({**equipment, "wafers": made, "lots": lots}, catalog)


def test_route_is_dealt_evenly(spark, equipment):
    expanded = route(spark, equipment)
    assert expanded.count() == 240
    dealt = shaping.round_robin_assign(expanded, shaping.assignment_catalog(equipment, MODULES)).collect()
    assert len(dealt) == 240
    etch = [r for r in dealt if r.process_module == "Etch"]
    assert {r.chamber_id: sum(x.chamber_id == r.chamber_id for x in etch) for r in etch} == dict.fromkeys(range(1, 9), 6)
    assert {r.chamber_id for r in etch if r.wafer_id % 8 == 5} == {6}


def test_schedule_follows_the_route(spark, equipment):
    first = shaping.route_schedule(route(spark, equipment, 1)).orderBy("sequence_order").first()
    assert (first.run_start, first.run_end) == (datetime(2024, 1, 5, 5, 0), datetime(2024, 1, 5, 5, 20))


@pytest.mark.parametrize("size", [2, 3, 100])
def test_counts_become_rows_whatever_the_ranges(spark, monkeypatch, size):
    monkeypatch.setattr(shaping, "RANGE_ROWS", size)
    headers = spark.createDataFrame([(1, 0, "a"), (2, 1, "b"), (3, 7, "c"), (4, None, "d")], "inspection_id int, defect_count int, tag string")
    found = sorted(rows(shaping.explode_counts(headers).select("inspection_id", "tag", "defect_seq")))
    assert found == [(2, "b", 1)] + [(3, "c", n) for n in range(1, 8)]


def test_a_header_of_many_defects_is_unfolded_whole(spark):
    made = shaping.explode_counts(spark.createDataFrame([(1, 100_000)], "inspection_id int, defect_count int"))
    assert made.agg(F.count("*"), F.min("defect_seq"), F.max("defect_seq"), F.countDistinct("defect_seq")).first() == (100_000, 1, 100_000, 100_000)


def test_grid_zones(spark):
    axis = spark.range(1, 13)
    grid = shaping.radial_zone(axis.selectExpr("CAST(id AS int) AS die_x", "explode(sequence(1, 12)) AS die_y"))
    corner = grid.filter("die_x = 1 AND die_y = 12").first()
    assert (corner.dist_sq, corner.zone) == (60.5, "edge")
    zones = {r.zone: r["count"] for r in grid.groupBy("zone").count().collect()}
    assert zones == {"center": 80, "mid": 40, "edge": 24}


def test_metrics_are_read_only_where_they_apply(spark):
    runs = spark.createDataFrame([(1, "M", datetime(2024, 1, 1)), (2, "D", datetime(2024, 1, 1)), (3, "X", datetime(2024, 1, 1))], "process_run_id int, module string, run_start timestamp_ntz")
    one, none = F.lit(Decimal("1.5")), F.lit(None)
    metrics = [
        shaping.Metric("CD", F.col("module") == "M", one, one, none, none, "nm"),
        shaping.Metric("Overlay", F.col("module") == "M", one, one, none, none, "nm"),
        shaping.Metric("Film", F.col("module") == "D", one, one, none, none, "A"),
    ]
    found = sorted((r.process_run_id, r.metric_type, r.value, r.unit) for r in shaping.metrology_long(runs, metrics).collect())
    assert found == [(1, "CD", Decimal("1.5000"), "nm"), (1, "Overlay", Decimal("1.5000"), "nm"), (2, "Film", Decimal("1.5000"), "A")]


def test_an_ambiguous_tool_code_is_an_error(fab):
    from waferscope.operators.cohort import suspect_tool

    tables = fab(tools=[{"tool_code": "E1"}, {"tool_code": "E1"}], wafers=wafers(1))
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        tables["wafers"].select(suspect_tool(tables, Suspect.named("E1", "A"), "tool_id")).collect()
