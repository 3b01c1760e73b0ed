"""Operators against plain Python on generated rows."""

from hypothesis import given, settings
from hypothesis import strategies as st

from panelkit import operators as op
from tests.conftest import rows

few = settings(max_examples=8, deadline=None)
keys = st.sampled_from(["a", "b", "c", None])
years = st.integers(2000, 2006)
values = st.one_of(st.none(), st.integers(-50, 50))


def unique(tuples):
    """At most one row per (key, year)."""
    return list({r[:2]: r for r in tuples}.values())


def series(frame_rows):
    return unique([r for r in frame_rows if r[0] is not None])


table = st.lists(st.tuples(keys, years, values), max_size=15).map(unique)
panel = st.lists(st.tuples(keys, years, values), min_size=1, max_size=25).map(series)


@few
@given(table, table, table)
def test_outer_panel_is_a_chain_of_full_joins(spark, a, b, c):
    frames = [
        spark.createDataFrame(data, f"k STRING, y INT, v{i} INT") for i, data in enumerate((a, b, c))
    ]
    joined = frames[0].join(frames[1], ["k", "y"], "full").join(frames[2], ["k", "y"], "full")
    order = ["k", "y", "v0", "v1", "v2"]
    assert rows(op.outer_panel(frames, ["k", "y"]), *order) == rows(joined.select(*order), *order)


@few
@given(panel)
def test_dense_grid_is_complete_and_keeps_what_was_there(spark, data):
    df = spark.createDataFrame(data, "k STRING, y INT, v INT")
    found = {(r["k"], r["y"]): r["v"] for r in op.densify(df, "k", "y", {"v": 0}).collect()}
    if not data:
        assert not found
        return
    span = range(min(r[1] for r in data), max(r[1] for r in data) + 1)
    assert set(found) == {(k, y) for k in {r[0] for r in data} for y in span}
    known = {(k, y): v or 0 for k, y, v in data}
    assert all(v == known.get(key, 0) for key, v in found.items())


@few
@given(panel)
def test_growth_and_projection(spark, data):
    df = spark.createDataFrame(data, "k STRING, y INT, v INT")
    grown = op.naive_projection(op.yoy_growth(df, ["k"], "y", "v", min_base=10), ["k"], "y", "v")
    before = {}
    for k, y, v in sorted(data):
        before[k, y] = next(((py, pv) for pk, py, pv in sorted(data, reverse=True) if pk == k and py < y), None)
    for r in grown.collect():
        previous = before[r["k"], r["y"]]
        usable = previous and previous[0] == r["y"] - 1 and previous[1] is not None
        if usable and abs(previous[1]) >= 10 and r["v"] is not None:
            assert abs(r["v_growth_pct"] - (r["v"] - previous[1]) * 100 / previous[1]) <= 0.005 + 1e-9
        else:
            assert r["v_growth_pct"] is None
        if usable and previous[1] != 0:
            assert r["v_projection"] == max(0, 2 * r["v"] - previous[1] if r["v"] is not None else 0)
        else:
            assert r["v_projection"] is None


@few
@given(panel)
def test_scores_lie_between_0_and_1_and_reach_both_ends(spark, data):
    df = spark.createDataFrame(data, "k STRING, y INT, v INT")
    by_year = {}
    for r in op.minmax_score(df, "y", {"s": "v"}, 6).collect():
        by_year.setdefault(r["y"], []).append((r["v"], r["s"]))
    for found in by_year.values():
        known = [v for v, _ in found if v is not None]
        if len(set(known)) < 2:
            assert all(s is None for _, s in found)
        else:
            scores = [s for v, s in found if v is not None]
            assert min(scores) == 0 and max(scores) == 1
            assert all(s is None for v, s in found if v is None)


@few
@given(panel, st.randoms(use_true_random=False))
def test_latest_by_is_idempotent_and_ignores_order(spark, data, random):
    shuffled = data[:]
    random.shuffle(shuffled)
    schema = "k STRING, y INT, v INT"
    once = op.latest_by(spark.createDataFrame(data, schema), ["k"], "y")
    other = op.latest_by(spark.createDataFrame(shuffled, schema), ["k"], "y")
    assert rows(once, "k") == rows(other, "k") == rows(op.latest_by(once, ["k"], "y"), "k")
