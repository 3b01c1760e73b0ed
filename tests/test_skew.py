"""A third of all rows under one key: results stay whole, and what is shuffled stays small."""

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from panelkit import operators as op
from tests.conftest import rows

N = 30_000
START = datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    data = [
        (0 if i % 3 == 0 else i % 997, 2000 + i % 7, i % 4, START + timedelta(minutes=(i * 7919) % N), i)
        for i in range(N)
    ]
    return data, spark.createDataFrame(data, "k INT, year INT, level INT, at TIMESTAMP, v INT").repartition(8)


def test_latest_by(skewed):
    data, df = skewed
    best = {}
    for r in data:
        if r[0] not in best or (r[3], r[4]) > (best[r[0]][3], best[r[0]][4]):
            best[r[0]] = r
    newest = op.latest_by(df, ["k"], "at", ["v"])
    assert rows(newest, "k") == [best[k] for k in sorted(best)]


def test_latest_value(skewed):
    data, df = skewed
    best = defaultdict(lambda: (START, -1))
    for k, _, _, at, v in data:
        best[k] = max(best[k], (at, v))
    assert rows(op.latest_value(df, ["k"], ["v"], "at"), "k") == [(k, best[k][1]) for k in sorted(best)]


def test_at_max_level_and_category_features(skewed):
    data, df = skewed
    top = defaultdict(int)
    for k, year, level, *_ in data:
        top[k, year] = max(top[k, year], level)
    expected = [r for r in data if r[2] == top[r[0], r[1]]]
    assert op.at_max_level(df, ["k", "year"], "level").count() == len(expected)
    totals = defaultdict(int)
    for k, year, level, _, v in expected:
        totals[k, year] += v if level == 3 else 0
    features = op.category_features(df, ["k", "year"], "level", "level", {"s": (3, "v")})
    assert {(r["k"], r["year"]): r["s"] for r in features.collect()} == dict(totals)


def test_scores_within_one_huge_period(skewed):
    data, df = skewed
    scored = op.minmax_score(df, "k", {"s": "v"}, 9)
    hot = [r[4] for r in data if r[0] == 0]
    lo, hi = min(hot), max(hot)
    found = {r["v"]: r["s"] for r in scored.filter("k = 0").collect()}
    assert found == {v: pytest.approx((v - lo) / (hi - lo), abs=1e-9) for v in hot}


def test_semi_filter_keeps_every_row_of_the_hot_key(skewed, frame):
    data, df = skewed
    wanted = frame("k INT", (0,), (0,), (5,))
    assert op.semi_filter(df, wanted, ["k"]).count() == sum(r[0] in (0, 5) for r in data)


@pytest.fixture
def eager_splitting(spark):
    """Thresholds low enough for the small frame to count as skewed, and no broadcast to avoid it."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "25KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("operator", ["at_max_level", "semi_filter", "enrich", "minmax_score"])
def test_a_hot_key_is_split_over_tasks(spark, eager_splitting, operator):
    numbers = spark.range(200_000, numPartitions=8)
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    df = numbers.select(
        hot.alias("k"), (F.col("id") % 2).alias("level"), (F.col("id") % 1000).alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    dimension = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("d"))
    result = {
        "at_max_level": lambda: op.at_max_level(df, ["k"], "level"),
        "semi_filter": lambda: op.semi_filter(df, dimension, ["k"]),
        "enrich": lambda: op.enrich(df, [dimension], ["k"]),
        "minmax_score": lambda: op.minmax_score(df, "k", {"s": "v"}),
    }[operator]()
    execution = result._jdf.queryExecution()
    assert execution.toRdd().count() > 0
    final = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in final
