"""Next-period tier forecast with a class-weighted random forest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import TIERS, decode_tier, encode_tier
from panelkit.operators.series import lead_value
from panelkit.sources.tables import checkpointed


@dataclass(frozen=True)
class ForestSpec:
    """What to predict from what, and how the forest is grown."""

    entity: str
    period: str
    tier: str
    features: Sequence[str]
    flags: Sequence[str] = ()
    filled: Sequence[str] = ()
    fill_value: float = -1.0
    holdout: int = 2
    labels: Sequence[str] = TIERS
    num_trees: int = 100
    max_depth: int = 6
    min_instances: int = 5
    seed: int = 42
    #: Partitions of the training rows, at least, and how many rows each gets at most, about. The bootstrap samples depend on
    #: their number, so it follows from the rows and these values and not from the cluster or how the rows come: the same
    #: rows give the same forest anywhere, and more rows are grown from in more tasks.
    partitions: int = 16
    partition_rows: int = 50_000


def lead_label(df: DataFrame, spec: ForestSpec) -> DataFrame:
    """Encode the tier, and add the entity's next tier as label with the period it belongs to."""
    encoded = df.withColumn("tier_code", encode_tier(F.col(spec.tier), spec.labels))
    labelled = lead_value(encoded, [spec.entity], spec.period, "tier_code", out="label")
    return labelled.withColumn("target_period", F.col(spec.period) + 1)


def prepare_features(df: DataFrame, spec: ForestSpec) -> DataFrame:
    """Labelled rows with flags as numbers and the sentinel for missing values of ``filled``."""
    prepared = lead_label(df, spec).withColumns({c: F.col(c).cast("double") for c in spec.flags})
    return prepared.fillna(spec.fill_value, subset=[*spec.filled, "tier_code"])


def assemble(df: DataFrame, spec: ForestSpec) -> DataFrame:
    """Add the feature vector; rows with a feature still missing are skipped."""
    assembler = VectorAssembler(inputCols=list(spec.features), outputCol="features", handleInvalid="skip")
    return assembler.transform(df)


def skipped_rows(df: DataFrame, spec: ForestSpec) -> DataFrame:
    """The rows ``assemble`` skips."""
    return df.filter(F.greatest(*[(F.col(c).isNull() | F.isnan(c)).cast("int") for c in spec.features]) == 1)


def temporal_split(df: DataFrame, period: str, holdout: int = 2) -> DataFrame:
    """Mark the rows of the last ``holdout`` periods as ``is_test``."""
    last = df.agg(F.max(period).alias("last")).scalar()
    return df.withColumn("is_test", F.col(period) > last - holdout)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Weight per class, inverse to its frequency: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    all_classes = counts.agg(
        F.struct(F.sum("class_rows").alias("rows"), F.count(F.lit(1)).alias("classes")).alias("totals")
    ).scalar()
    return counts.withColumn(
        "class_weight", all_classes["rows"] / (all_classes["classes"] * F.col("class_rows"))
    )


def add_class_weights(df: DataFrame, spec: ForestSpec, label: str = "label") -> DataFrame:
    """Attach the weight of a row's class. One row per tier is broadcast: at most ``len(labels)``."""
    known = df.filter(F.col(label).isin(*[float(i) for i in range(len(spec.labels))]))
    weights = class_weights(known, label).select(label, "class_weight")
    return df.join(F.broadcast(weights), label, "left").fillna(1.0, subset=["class_weight"])


def training_partitions(rows: int, spec: ForestSpec) -> int:
    """Into how many partitions so many training rows go: the least number, doubled until they are small enough."""
    found = spec.partitions
    while rows > found * spec.partition_rows:
        found *= 2
    return found


def fit_forest(train: DataFrame, spec: ForestSpec) -> RandomForestClassificationModel:
    """Grow the forest. Rows are partitioned by entity and period and ordered by them, into a number of partitions that
    their own number sets, so the same data give the same bootstrap samples on every run. An entity's rows
    are spread, so one with many of them makes no large partition."""
    partitions = training_partitions(train.count(), spec)
    ordered = (
        add_class_weights(train, spec)
        .select(spec.entity, spec.period, "features", "label", "class_weight")
        .repartition(partitions, spec.entity, spec.period)
        .sortWithinPartitions(spec.entity, spec.period)
    )
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="class_weight",
        numTrees=spec.num_trees,
        maxDepth=spec.max_depth,
        minInstancesPerNode=spec.min_instances,
        seed=spec.seed,
    )
    return forest.fit(ordered)


def importances(model: RandomForestClassificationModel, spec: ForestSpec) -> DataFrame:
    """Features by importance, highest first (one row per feature of the model)."""
    rows = [(f, float(v)) for f, v in zip(spec.features, model.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(
        F.desc("importance"), "feature"
    )


def decoded(predictions: DataFrame, spec: ForestSpec) -> DataFrame:
    """Add the predicted tier and the probability of the winning class."""
    confidence: Column = F.array_max(vector_to_array(F.col("probability")))
    return predictions.withColumns({
        "predicted_tier": decode_tier(F.col("prediction"), spec.labels),
        "prediction_confidence": confidence,
    })


def forecast_next(
    model: RandomForestClassificationModel, prepared: DataFrame, spec: ForestSpec
) -> DataFrame:
    """Predict the period after the latest one of the whole frame, for the entities seen in it."""
    last = prepared.agg(F.max(spec.period).alias("last")).scalar()
    latest = assemble(prepared.filter(F.col(spec.period) == last), spec)
    return decoded(model.transform(latest), spec).withColumn("forecast_period", F.col(spec.period) + 1)


@dataclass(frozen=True)
class ForestRun:
    """A fitted forest with its test predictions and the forecast."""

    model: RandomForestClassificationModel
    test_predictions: DataFrame
    forecast: DataFrame


def run_forest(history: DataFrame, spec: ForestSpec) -> ForestRun:
    """Label, split by time, fit on the past, predict the held-out periods and the next one.

    Training passes over its rows several times, so the prepared rows are written once.
    """
    prepared = checkpointed(prepare_features(history, spec))
    labelled = prepared.filter(F.col("label").isNotNull())
    split = assemble(temporal_split(labelled, "target_period", spec.holdout), spec)
    model = fit_forest(split.filter(~F.col("is_test")), spec)
    tested = decoded(model.transform(split.filter("is_test")), spec)
    return ForestRun(model, tested, forecast_next(model, prepared, spec))
