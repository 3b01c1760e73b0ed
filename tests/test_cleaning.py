from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit import operators as op
from tests.conftest import rows

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_require_not_null_checks_every_column(frame):
    df = frame("a INT, b STRING", (1, "x"), (None, "x"), (1, None))
    assert rows(op.require_not_null(df, ["a", "b"])) == [(1, "x")]


def test_null_if_cast(frame):
    df = frame("a STRING, b STRING", ("-", "3"), ("7", "-"), ("x", None))
    assert rows(op.null_if_cast(df, ["a", "b"], "int"), "a") == [(None, 3), (None, None), (7, None)]


def test_latest_by_takes_newest_and_groups_null_keys(frame):
    df = frame(
        "k STRING, p STRING, at TIMESTAMP, v INT",
        ("a", None, T1, 1), ("a", None, T2, 2), ("b", "x", None, 3), ("b", "x", T1, 4), ("c", "x", T1, 5),
    )
    newest = op.latest_by(df, ["k", "p"], "at")
    assert rows(newest.select("k", "v"), "k") == [("a", 2), ("b", 4), ("c", 5)]
    again = op.latest_by(newest, ["k", "p"], "at")
    assert rows(again, "k") == rows(newest, "k")


def test_latest_by_tie_does_not_depend_on_order(frame):
    data = [("a", T1, i) for i in range(20)]
    forward = op.latest_by(frame("k STRING, at TIMESTAMP, v INT", *data), ["k"], "at")
    backward = op.latest_by(frame("k STRING, at TIMESTAMP, v INT", *reversed(data)), ["k"], "at")
    assert rows(forward) == rows(backward)
    chosen = op.latest_by(frame("k STRING, at TIMESTAMP, v INT", *data), ["k"], "at", ["v"])
    assert rows(chosen) == [("a", T1, 19)]


def test_latest_value_takes_all_values_from_one_row(frame):
    df = frame(
        "k STRING, at TIMESTAMP, r DOUBLE, f DOUBLE",
        ("a", T1, 1.0, 10.0), ("a", T2, 2.0, None), ("b", None, 3.0, 30.0), ("b", T1, 4.0, 40.0), ("c", None, 5.0, None),
    )
    assert rows(op.latest_value(df, ["k"], ["r", "f"], "at"), "k") == [
        ("a", 2.0, None), ("b", 4.0, 40.0), ("c", 5.0, None),
    ]


def test_one_per_key_is_ordered(frame):
    df = frame("k STRING, y INT", ("a", 3), ("a", 1), ("b", None), ("b", 2))
    assert rows(op.one_per_key(df, ["k"], [F.col("y").asc_nulls_last()]), "k") == [("a", 1), ("b", 2)]


def test_date_parts(frame):
    df = frame("s STRING", ("2021-03-04T00:00:00",), ("2021-03-04",), (None,))
    assert rows(op.date_parts(df, "s").select("year", "month", "day"), "year") == [
        (None, None, None), (None, None, None), (2021, 3, 4),
    ]


def test_explode_years(frame):
    iso = "{}-06-01T00:00:00".format
    df = frame(
        "i INT, s STRING, e STRING",
        (1, iso(2020), iso(2020)), (2, iso(2019), iso(2021)), (3, iso(2021), iso(2020)), (4, None, iso(2020)),
        (5, "2020", iso(2020)),
    )
    assert rows(op.explode_years(df, "s", "e").select("i", "year"), "i", "year") == [
        (1, 2020), (2, 2019), (2, 2020), (2, 2021), (3, 2020), (3, 2021),
    ]
    assert rows(op.unparsed_periods(df, "s", "e").select("i"), "i") == [(4,), (5,)]


def test_fill_coalesce_tag(frame):
    df = frame("a INT, x STRING, y STRING", (None, None, "y"), (1, "x", "y"))
    filled = op.fill_nulls(df, 0, ["a"])
    named = op.tag(op.coalesce_columns(filled, "x", "x", "y"), is_forecast=False)
    assert rows(named, "a") == [(0, "y", False), (1, "x", False)]
    assert named.columns == ["a", "x", "is_forecast"]


def test_conform_gives_typed_nulls(frame):
    schema = StructType.fromDDL("k STRING, year INT, v DOUBLE, f BOOLEAN")
    df = op.conform(frame("k STRING, y BIGINT", ("a", 2020)), schema, {"k": F.col("k"), "year": F.col("y") + 1})
    assert df.schema.simpleString() == schema.simpleString()
    assert rows(df) == [("a", 2021, None, None)]
