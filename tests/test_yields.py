from decimal import Decimal

from conftest import dies, rows, run, wafers
from waferscope.operators import yields


def test_wafer_yield_rounds_half_up_and_skips_wafers_without_dies(fab):
    tables = fab(wafers=wafers(1, 2, 3), bin_results=dies(1, 2, 1) + dies(2, 1, 7))
    found = {r.wafer_id: r for r in yields.wafer_yield(tables).collect()}
    assert set(found) == {1, 2}
    assert (found[1].total_dies, found[1].pass_dies, found[1].yield_pct) == (3, 2, Decimal("66.67"))
    assert found[2].yield_pct == Decimal("12.50")


def test_rollups_weight_by_dies_not_by_wafers(fab):
    tables = fab(
        lots=[{"lot_number": "L1", "product": "P1"}, {"lot_number": "L2", "product": "P2"}],
        wafers=wafers(1, 2) + wafers(3, lot=2),
        bin_results=dies(1, 1, 0) + dies(2, 0, 9) + dies(3, 1, 1),
    )
    by_lot = rows(yields.yield_by_lot(tables))
    assert [(r[0], r[3], r[4], r[5], r[6]) for r in by_lot] == [
        ("L1", 2, 10, 1, Decimal("10.00")),
        ("L2", 1, 2, 1, Decimal("50.00")),
    ]
    assert rows(yields.yield_by_product(tables)) == [("P2", 1, Decimal("50.00")), ("P1", 2, Decimal("10.00"))]
    assert rows(yields.yield_by_node(tables)) == [("N", 3, Decimal("16.67"))]


def test_a_wafer_counts_once_per_tool(fab):
    tables = fab(
        wafers=wafers(1, 2),
        bin_results=dies(1, 1, 1) + dies(2, 2, 0),
        process_runs=[run(1, 1, 1), run(1, 1, 2, step=2), run(2, 1, None), run(2, 3, 4)],
    )
    assert rows(yields.yield_by_tool(tables)) == [
        ("E1", "Etcher", 2, Decimal("75.00")),
        ("D1", "Deposition", 1, Decimal("100.00")),
    ]
