import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from panelkit.operators import classification_report, forest
from panelkit.operators.forest import ForestSpec
from tests.conftest import rows

SPEC = ForestSpec(
    entity="k", period="year", tier="tier", features=("level", "tier_code", "growth", "flag"), flags=("flag",),
    filled=("growth",), num_trees=10, max_depth=4, min_instances=1, partitions=2,
)


@pytest.fixture
def history(frame):
    def row(k, y):
        level = (k * 7 + y * 3) % 40 / 10
        return (f"k{k:02d}", y, ("Low", "Medium", "High", "Critical")[int(level)], level, None if y == 2000 else level / 2,
                k % 2 == 0)

    return frame(
        "k STRING, year INT, tier STRING, level DOUBLE, growth DOUBLE, flag BOOLEAN",
        *[row(k, y) for k in range(30) for y in range(2000, 2010)],
    )


def test_lead_label_and_sentinels(frame):
    df = frame(
        "k STRING, year INT, tier STRING, level DOUBLE, growth DOUBLE, flag BOOLEAN",
        ("a", 2000, "Low", 1.0, None, True), ("a", 2001, None, None, 0.5, False), ("a", 2002, "High", 3.0, 0.1, None),
    )
    prepared = forest.prepare_features(df, SPEC)
    columns = ["year", "tier_code", "label", "target_period", "growth", "flag"]
    assert rows(prepared.select(*columns), "year") == [
        (2000, 0.0, None, 2001, -1.0, 1.0), (2001, -1.0, 2.0, 2002, 0.5, 0.0), (2002, 2.0, None, 2003, 0.1, None),
    ]
    assert [r["year"] for r in forest.assemble(prepared, SPEC).collect()] == [2000]
    assert sorted(r["year"] for r in forest.skipped_rows(prepared, SPEC).collect()) == [2001, 2002]


def test_split_takes_the_last_two_periods(frame):
    df = frame("t INT", *[(t,) for t in range(2000, 2006)])
    assert [r["t"] for r in forest.temporal_split(df, "t").filter("is_test").orderBy("t").collect()] == [2004, 2005]


def test_class_weights(frame):
    df = frame("label DOUBLE", *[(0.0,)] * 6, *[(1.0,)] * 3, (3.0,))
    assert rows(forest.class_weights(df, "label"), "label") == [
        (0.0, 6, 10 / 18), (1.0, 3, 10 / 9), (3.0, 1, 10 / 3),
    ]
    weighted = forest.add_class_weights(df, SPEC)
    assert weighted.count() == 10
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(10)


def test_run_is_complete_and_repeatable(history):
    run = forest.run_forest(history, SPEC)
    forecast = run.forecast
    assert forecast.count() == 30
    assert {r[0] for r in forecast.select("forecast_period").distinct().collect()} == {2010}
    assert forecast.filter("prediction_confidence < 0.25 OR prediction_confidence > 1").count() == 0
    assert forecast.filter("predicted_tier IS NULL").count() == 0
    # labels reach from 2001 to 2009; the last two target years are held out
    assert {r[0] for r in run.test_predictions.select("target_period").distinct().collect()} == {2008, 2009}
    columns = ["k", "predicted_tier", "prediction_confidence"]
    again = forest.run_forest(history, SPEC).forecast
    assert rows(again.select(*columns), "k") == rows(forecast.select(*columns), "k")
    ranked = forest.importances(run.model, SPEC).collect()
    assert {r["feature"] for r in ranked} == set(SPEC.features)
    assert sum(r["importance"] for r in ranked) == pytest.approx(1)
    assert [r["importance"] for r in ranked] == sorted((r["importance"] for r in ranked), reverse=True)


def test_report_agrees_with_the_evaluator(history):
    tested = forest.run_forest(history, SPEC).test_predictions
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for r in classification_report(tested, "label", "prediction", [0.0, 1.0, 2.0, 3.0]).collect():
        for metric, value in (("fMeasureByLabel", r["f1"]), ("recallByLabel", r["recall"])):
            options = {evaluator.metricName: metric, evaluator.metricLabel: float(r["label"])}
            assert evaluator.evaluate(tested, options) == pytest.approx(value)


def test_more_rows_go_to_more_partitions():
    spec = ForestSpec(**{**SPEC.__dict__, "partitions": 16, "partition_rows": 100})
    assert [forest.training_partitions(n, spec) for n in (0, 1600, 1601, 3200, 100_000)] == [16, 16, 32, 32, 1024]


def test_the_same_forest_however_the_rows_come(spark, history):
    prepared = forest.prepare_features(history, SPEC).filter("label IS NOT NULL")
    spec = ForestSpec(**{**SPEC.__dict__, "partition_rows": 60})
    found = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in (4, 16, 64):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        train = forest.assemble(prepared.orderBy(F.rand(partitions)).repartition(partitions), spec)
        model = forest.fit_forest(train, spec)
        found.add((model.toDebugString.partition("\n")[2], str(model.featureImportances)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == 1
