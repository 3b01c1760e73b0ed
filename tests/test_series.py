from panelkit import operators as op
from tests.conftest import rows

SERIES = "k STRING, year INT, v BIGINT"


def test_lag_with_and_without_gap_guard(frame):
    df = frame(SERIES, ("a", 2000, 1), ("a", 2001, 2), ("a", 2003, 3), ("b", 2003, 9))
    plain = op.lag_value(df, ["k"], "year", "v")
    guarded = op.lag_value(plain, ["k"], "year", "v", guard_gap=True, out="g")
    two = op.lag_value(guarded, ["k"], "year", "v", n=2, out="two")
    assert rows(two, "k", "year") == [
        ("a", 2000, 1, None, None, None), ("a", 2001, 2, 1, 1, None), ("a", 2003, 3, 2, None, 1),
        ("b", 2003, 9, None, None, None),
    ]


def test_lead(frame):
    df = frame(SERIES, ("a", 2000, 1), ("a", 2001, 2))
    assert [r[-1] for r in rows(op.lead_value(df, ["k"], "year", "v"), "year")] == [2, None]


def test_growth_needs_consecutive_years_and_a_base(frame):
    df = frame(
        SERIES,
        ("a", 2000, 1000), ("a", 2001, 1500), ("a", 2002, 3000), ("a", 2004, 4000), ("a", 2005, 4400),
        ("b", 2000, 999), ("b", 2001, 5000), ("b", 2002, None), ("b", 2003, 8000),
    )
    grown = op.yoy_growth(df, ["k"], "year", "v", min_base=1000)
    assert [r[3:] for r in rows(grown, "k", "year")] == [
        (None, None, None), (1000, 50.0, None), (1500, 100.0, 50.0), (3000, None, None), (4000, 10.0, None),
        (None, None, None), (999, None, None), (5000, None, None), (None, None, None),
    ]


def test_acceleration_uses_rounded_growth(frame):
    df = frame(SERIES, ("a", 1, 3000), ("a", 2, 4000), ("a", 3, 5000))
    last = rows(op.yoy_growth(df, ["k"], "year", "v"), "year")[-1]
    assert last[-2:] == (25.0, -8.33)


def test_projection(frame):
    df = frame(
        SERIES,
        ("a", 2000, 100), ("a", 2001, 40), ("a", 2002, 70), ("a", 2004, 70), ("a", 2005, None),
        ("b", 2000, 0), ("b", 2001, 5),
    )
    projected = op.naive_projection(df, ["k"], "year", "v")
    assert [r[3:] for r in rows(projected, "k", "year")] == [
        (100.0, None, None),
        (70.0, 0, 100.0),
        (70.0, 100, 42.9),
        (70.0, None, None),
        # the current value is missing after a known one: projects to 0
        (70.0, 0, 100.0),
        (0.0, None, None),
        (3.0, None, None),
    ]


def test_moving_average_is_by_period_not_by_row(frame):
    df = frame(SERIES, ("a", 2000, 10), ("a", 2001, 20), ("a", 2004, 60))
    assert [r[-1] for r in rows(op.moving_avg(df, ["k"], "year", "v", digits=None), "year")] == [10.0, 15.0, 60.0]
