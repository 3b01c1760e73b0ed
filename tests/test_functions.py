import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit import functions as fn
from tests.conftest import rows


def values(frame, schema, data, expression):
    df = frame("i INT, " + schema, *[(i, *d) for i, d in enumerate(data)])
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_tier_bounds_are_exclusive_or_inclusive(frame):
    data = [(None,), (0.0,), (0.3,), (0.300001,), (0.5,), (0.7,), (0.71,)]
    below = values(frame, "x DOUBLE", data, fn.tier(F.col("x"), (0.3, 0.5, 0.7)))
    assert below == [None, "Low", "Medium", "Medium", "High", "Critical", "Critical"]
    upto = values(frame, "x DOUBLE", data, fn.tier(F.col("x"), (0.3, 0.5, 0.7), inclusive=True))
    assert upto == [None, "Low", "Low", "Medium", "Medium", "High", "Critical"]


def test_tier_needs_a_label_per_interval():
    with pytest.raises(ValueError):
        fn.tier(F.col, (1, 2, 3, 4))


def test_tier_codes_round_trip(frame):
    data = [("Low",), ("Critical",), ("other",), (None,)]
    codes = values(frame, "t STRING", data, fn.encode_tier(F.col("t")))
    assert codes == [0.0, 3.0, None, None]
    assert values(frame, "c DOUBLE", [(c,) for c in codes], fn.decode_tier(F.col("c"))) == [
        "Low", "Critical", None, None,
    ]


def test_growth_rate_from_zero(frame):
    data = [(5, None), (0, 0), (4, 0), (0, 4), (6, 4), (None, 4)]
    assert values(frame, "v BIGINT, p BIGINT", data, fn.growth_rate(F.col("v"), F.col("p"))) == [
        None, 0.0, None, -1.0, 0.5, None,
    ]


def test_ratios_guard_zero_and_null(frame):
    data = [(1.0, 0.0), (1.0, None), (None, 2.0), (1.0, 2.0), (1.0, -2.0)]
    a, b = F.col("a"), F.col("b")
    assert values(frame, "a DOUBLE, b DOUBLE", data, fn.ratio(a, b)) == [None, None, None, 0.5, -0.5]
    assert values(frame, "a DOUBLE, b DOUBLE", data, fn.guarded_ratio(a, b)) == [None, None, None, 0.5, None]
    # received, required: nothing received is a full gap, nothing required none at all
    assert values(frame, "a DOUBLE, b DOUBLE", data, fn.gap_ratio(b, a)) == [None, None, 1.0, 0.5, None]


def test_log_index_is_capped_and_keeps_null(frame):
    data = [(None,), (0.0,), (9.0,), (1e9,), (-0.5,), (-1.0,), (-2.0,)]
    assert values(frame, "x DOUBLE", data, fn.log_index(F.col("x"))) == [
        None, 0.0, 25.0, 100.0, -7.53, None, None,
    ]


def test_effective_flag_before_at_and_after(frame):
    data = [
        (2019, 2020, True), (2020, 2020, True), (2021, 2020, None), (2021, None, True), (2021, 2020, False),
    ]
    flag = fn.effective_flag(F.col("y"), F.col("e"), F.col("f"))
    assert values(frame, "y INT, e INT, f BOOLEAN", data, flag) == [False, True, False, False, False]


def test_counting_three_valued_flags(frame):
    data = [(True, None, False), (None, None, None), (True, True, True)]
    flags = [F.col(c) for c in "abc"]
    schema = "a BOOLEAN, b BOOLEAN, c BOOLEAN"
    assert values(frame, schema, data, fn.count_true(*flags)) == [1, 0, 3]
    assert values(frame, schema, data, fn.count_known(*flags)) == [2, 0, 3]


def test_per_capita(frame):
    data = [(5, 1000.0), (5, 0.0), (5, None), (None, 10.0)]
    assert values(frame, "a BIGINT, p DOUBLE", data, fn.per_capita(F.col("a"), F.col("p"))) == [
        5.0, None, None, None,
    ]


def test_preferred_max_falls_back_to_unnamed_category(frame):
    df = frame(
        "k STRING, s STRING, c STRING, v INT",
        ("a", "INN", "total", 5), ("a", "INN", None, 9), ("b", "INN", "", 7), ("b", "INN", None, 3),
        ("c", "INN", "men", 4), ("d", "TGT", "total", 1),
    )
    own = F.col("s") == "INN"
    metric = fn.preferred_max(F.col("v"), own & (F.col("c") == "total"), own & (F.coalesce("c", F.lit("")) == ""))
    assert rows(df.groupBy("k").agg(metric), "k") == [("a", 5), ("b", 7), ("c", None), ("d", None)]


def test_placeholder_and_dates(frame):
    data = [("-",), ("12",), ("x",), (None,)]
    assert values(frame, "s STRING", data, fn.null_if(F.col("s"), to_type="int")) == [None, 12, None, None]
    stamps = [("2024-02-29T00:00:00",), ("2024-02-29",), ("2023-02-29T00:00:00",), ("2024-02-29T00:00:00.5",)]
    strict = values(frame, "s STRING", stamps, fn.strict_date(F.col("s")).cast(T.StringType()))
    assert strict == ["2024-02-29", None, None, None]
    lenient = values(frame, "s STRING", stamps, fn.strict_date(F.col("s"), None).cast(T.StringType()))
    assert lenient == ["2024-02-29", "2024-02-29", None, "2024-02-29"]
