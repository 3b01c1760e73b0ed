import pytest
from pyspark.sql import functions as F

from panelkit import operators as op
from tests.conftest import rows


def test_outer_panel_keeps_every_key(frame):
    a = frame("k STRING, y INT, a INT", ("x", 1, 10), ("x", 2, 11))
    b = frame("k STRING, y INT, b DOUBLE", ("x", 2, 2.5), ("z", 1, 3.5))
    c = frame("k STRING, y INT, c BOOLEAN", ("z", 1, False))
    assert rows(op.outer_panel([a, b, c], ["k", "y"]), "k", "y") == [
        ("x", 1, 10, None, None), ("x", 2, 11, 2.5, None), ("z", 1, None, 3.5, False),
    ]


def test_outer_panel_equals_a_chain_of_joins(frame):
    a = frame("k STRING, y INT, a INT", ("x", 1, 10), ("x", None, 11), (None, 1, 12))
    b = frame("k STRING, y INT, b INT", ("x", 1, None), ("x", None, 21), (None, 1, 22), ("q", 5, 23))
    joined = a.join(b, ["k", "y"], "full_outer")
    panel = op.outer_panel([a, b], ["k", "y"])
    order = ["k", "y", "a", "b"]
    assert rows(panel, *order) == rows(joined.select(*order), *order)


def test_outer_panel_with_anchor_is_a_left_join(frame):
    a = frame("k INT, a INT", (1, 10), (2, None))
    b = frame("k INT, b INT", (2, 20), (3, 30))
    assert rows(op.outer_panel([a, b], ["k"], anchors=[0]), "k") == [(1, 10, None), (2, None, 20)]


def test_outer_panel_rejects_shared_columns(frame):
    a = frame("k INT, v INT", (1, 1))
    with pytest.raises(ValueError):
        op.outer_panel([a, a], ["k"])


def test_enrich_and_semi_filter(frame):
    facts = frame("k STRING, v INT", ("a", 1), ("b", 2), ("b", 3))
    dim = frame("k STRING, d INT", ("b", 7))
    assert rows(op.enrich(facts, [dim], ["k"]), "v") == [("a", 1, None), ("b", 2, 7), ("b", 3, 7)]
    repeated = frame("k STRING", ("b",), ("b",))
    assert rows(op.semi_filter(facts, repeated, ["k"]), "v") == [("b", 2), ("b", 3)]


def test_union_distinct(frame):
    a, b = frame("x STRING", ("p",), ("q",)), frame("y STRING", ("q",), ("r",))
    assert rows(op.union_distinct([a, b], [["x"], ["y"]], ["code"]), "code") == [("p",), ("q",), ("r",)]


def test_densify_size_and_fills(frame):
    df = frame("k STRING, y INT, v BIGINT, w DOUBLE", ("a", 2000, 1, 1.0), ("a", 2003, 2, None), ("b", 2001, 3, 3.0))
    dense = op.densify(df, "k", "y", {"v": 0})
    assert dense.count() == 2 * 4
    assert rows(dense.filter("k = 'b'"), "y") == [
        ("b", 2000, 0, None), ("b", 2001, 3, 3.0), ("b", 2002, 0, None), ("b", 2003, 0, None),
    ]


def test_densify_with_entities_and_span(frame):
    df = frame("k STRING, y INT, v BIGINT", ("a", 2001, 1), ("nameless", 2002, 5))
    named = frame("k STRING, name STRING", ("a", "A"))
    span = frame("y INT", (2000,), (2002,))
    assert rows(op.densify(df, "k", "y", {"v": 0}, named, span), "y") == [
        ("a", 2000, "A", 0), ("a", 2001, "A", 1), ("a", 2002, "A", 0),
    ]


def test_densify_of_nothing_is_nothing(frame):
    assert op.densify(frame("k STRING, y INT, v INT"), "k", "y", {"v": 0}).count() == 0


def test_averages_panel(frame):
    a = frame("k STRING, y INT, p DOUBLE", ("x", 1, 2.0), ("x", 1, 4.0), ("x", 1, None), ("x", None, 9.0))
    b = frame("k STRING, y INT, q DOUBLE", ("z", 1, 5.0), (None, 1, 1.0))
    assert rows(op.averages_panel([(a, {"mp": "p"}), (b, {"mq": "q"})], ["k", "y"]), "k") == [
        ("x", 1, 3.0, None), ("z", 1, None, 5.0),
    ]


ROUTE = "year INT, o STRING, h STRING, o_name STRING, r INT, i INT"
FLOW = "year INT, o STRING, h STRING, o_name STRING, out INT"


def route(frame, **options):
    stocks = frame(
        ROUTE,
        (2000, "A", "B", None, 10, None), (2000, "A", "B", "Aland", 5, 1), (2001, "A", "B", "Aland", 4, 0),
        (2003, "A", "B", None, 9, 0), (2000, "C", "C", "Cland", 0, 7),
    )
    flows = frame(FLOW, (2001, "A", "B", "Other", 3), (2002, "D", "B", "Dland", 8), (2003, "A", "B", "Late", None))
    return op.route_matrix(
        stocks, flows, ["o", "h"], "year", ["r", "i"], ["out"], {"o_name": "o_name"}, **options
    )


def test_route_matrix(frame):
    columns = ["o", "year", "o_name", "stock", "outflows", "inflows"]
    assert rows(route(frame).select(*columns), "o", "year") == [
        ("A", 2000, "Aland", 16, 0, None),
        ("A", 2001, "Aland", 4, 3, -9),
        ("A", 2003, "Late", 9, 0, 5),
        ("C", 2000, "Cland", 7, 0, None),
        ("D", 2002, "Dland", 0, 8, None),
    ]


def test_route_matrix_floored(frame):
    floored = rows(route(frame, floor_zero=True).select("o", "year", "inflows"), "o", "year")
    assert [r[2] for r in floored] == [None, 0, 5, None, None]


def test_flow_balance(frame):
    df = frame(
        "k STRING, y INT, s BIGINT, out BIGINT",
        ("a", 2000, 10, 1), ("a", 2001, 4, 2), ("a", 2003, 9, None), ("a", 2004, None, 3),
    )
    balanced = op.flow_balance(df, ["k"], "y", "s", "out")
    assert [r[4:] for r in rows(balanced, "y")] == [(None, None), (0, 4), (5, 0), (0, 0)]
    # arrivals less unexplained departures are the balance
    check = balanced.filter("s IS NOT NULL AND real_inflow IS NOT NULL").withColumn(
        "d", F.col("real_inflow") - F.col("untracked_outflow")
    )
    assert [r[-1] for r in rows(check, "y")] == [-4, 5]
