"""Reports and the tier forecast over the driver tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions import growth_rate, ratio, tier
from panelkit.operators import (
    classification_report,
    confusion,
    coverage_report,
    lag_value,
    macro_f1,
    quality_report,
)
from panelkit.operators import forest
from panelkit.operators.forest import ForestSpec
from parity.registry import query, rnd
from parity.views import cents, customer_year, funding, table, with_ctes


@query(name="quality_report", sql=with_ctes("customer_year", body=f"""
    SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS distinct_entities, min(year) AS period_min,
           max(year) AS period_max, count(nullif(n_orders, 1)) AS repeat_orders_known,
           count(amount_cents) AS amount_cents_known, {rnd("avg(n_orders)", 2)} AS n_orders_mean
    FROM customer_year"""))
def customer_quality(spark: SparkSession, d: str) -> DataFrame:
    df = customer_year(spark, d).withColumn("repeat_orders", F.nullif("n_orders", F.lit(1)))
    return quality_report(df, "o_custkey", "year", ["repeat_orders", "amount_cents"], ["n_orders"])


@query(name="coverage_report", sql=with_ctes("funding", body=f"""
    SELECT {rnd("count(funding_usd) / count(*) * 100", 1)} AS funding_usd,
           {rnd("count(reference_period_end) / count(*) * 100", 1)} AS reference_period_end,
           {rnd("count(requirements_usd) / count(*) * 100", 1)} AS requirements_usd
    FROM funding"""))
def funding_coverage(spark: SparkSession, d: str) -> DataFrame:
    return coverage_report(funding(spark, d), ["funding_usd", "reference_period_end", "requirements_usd"])


@query(sql="""
    SELECT quality, count(*) FILTER (toxic = 0) AS predicted_0, count(*) FILTER (toxic = 1) AS predicted_1,
           count(*) FILTER (toxic IS NULL OR toxic NOT IN (0, 1)) AS predicted_other
    FROM labels GROUP BY quality""")
def crosstab(spark: SparkSession, d: str) -> DataFrame:
    return confusion(table(spark, d, "labels"), "quality", "toxic", [0, 1])


@query(sql="""
    SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS "predicted_1-URGENT",
           count(*) FILTER (o_orderpriority = '5-LOW') AS "predicted_5-LOW",
           count(*) FILTER (o_orderpriority IS NULL OR o_orderpriority NOT IN ('1-URGENT', '5-LOW')) AS predicted_other
    FROM orders GROUP BY o_orderstatus""")
def crosstab_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Text labels, most rows outside them."""
    return confusion(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority", ["1-URGENT", "5-LOW"])


REPORT_SQL = """
    WITH classes AS (SELECT unnest([0, 1, 2]) AS label),
    counted AS (
      SELECT label, count(*) FILTER (quality = label) AS support, count(*) FILTER (toxic = label) AS predicted,
             count(*) FILTER (quality = label AND toxic = label) AS hits
      FROM classes CROSS JOIN labels GROUP BY label),
    shares AS (
      SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall
      FROM counted),
    report AS (
      SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM shares)"""


@query(name="classification_report", sql=f"{REPORT_SQL} SELECT * FROM report")
def labels_report(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity read as a prediction of quality; the third class never occurs."""
    return classification_report(table(spark, d, "labels"), "quality", "toxic", [0, 1, 2])


@query(sql=f"{REPORT_SQL} SELECT {rnd('avg(f1)', 6)} AS macro_f1 FROM report")
def macro_f1_score(spark: SparkSession, d: str) -> DataFrame:
    return macro_f1(labels_report(spark, d)).withColumn("macro_f1", F.round("macro_f1", 6))


# -- tier forecast per supplier -----------------------------------------------------------------

SPEC = ForestSpec(
    entity="supplier",
    period="year",
    tier="return_tier",
    features=("return_share", "tier_code", "quantity", "growth", "revenue", "is_busy", "mean_discount"),
    flags=("is_busy",),
    filled=("growth", "mean_discount"),
)

SUPPLIERS_SQL = """
    WITH sums AS (
      SELECT l_suppkey AS supplier, CAST(year(l_shipdate) AS INT) AS year, CAST(sum(l_quantity) AS BIGINT) AS quantity,
             CAST(coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS returned
      FROM lineitem GROUP BY 1, 2),
    tiered AS (
      SELECT supplier, year, CASE WHEN share < 0.25 THEN 'Low' WHEN share < 0.33 THEN 'Medium'
                                  WHEN share < 0.4 THEN 'High' ELSE 'Critical' END AS return_tier
      FROM (SELECT *, returned / quantity AS share FROM sums)),
    coded AS (
      SELECT *, CASE return_tier WHEN 'Low' THEN 0e0 WHEN 'Medium' THEN 1e0 WHEN 'High' THEN 2e0 ELSE 3e0 END AS tier_code
      FROM tiered),
    labelled AS (
      SELECT *, lead(tier_code) OVER (PARTITION BY supplier ORDER BY year) AS label,
             CAST(year + 1 AS INT) AS target_period
      FROM coded)"""


def _suppliers(spark: SparkSession, d: str) -> DataFrame:
    """Yearly returns and sales per supplier with a tier of the share returned."""
    sums = table(spark, d, "lineitem").groupBy(
        F.col("l_suppkey").alias("supplier"), F.year("l_shipdate").alias("year")
    ).agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)).cast("bigint").alias("returned"),
        (F.sum(cents("l_extendedprice")) / 100).alias("revenue"),
        F.avg(F.when(F.col("l_returnflag") == "R", cents("l_discount"))).alias("mean_discount"),
        (F.count(F.lit(1)) > 80).alias("is_busy"),
    )
    lagged = lag_value(sums, ["supplier"], "year", "quantity", out="_before")
    return lagged.withColumns({
        "return_share": ratio(F.col("returned"), F.col("quantity")),
        "growth": growth_rate(F.col("quantity"), F.col("_before")),
    }).withColumn("return_tier", tier(F.col("return_share"), (0.25, 0.33, 0.4))).drop("_before", "returned")


LABEL_COLUMNS = ["supplier", "year", "return_tier", "tier_code", "label", "target_period"]


@query(sql=f"{SUPPLIERS_SQL} SELECT * FROM labelled")
def lead_label(spark: SparkSession, d: str) -> DataFrame:
    return forest.lead_label(_suppliers(spark, d), SPEC).select(*LABEL_COLUMNS)


@query(sql=f"""{SUPPLIERS_SQL}
    SELECT supplier, year, label,
           target_period > (SELECT max(target_period) FROM labelled WHERE label IS NOT NULL) - 2 AS is_test
    FROM labelled WHERE label IS NOT NULL""")
def temporal_split(spark: SparkSession, d: str) -> DataFrame:
    labelled = lead_label(spark, d).filter("label IS NOT NULL")
    return forest.temporal_split(labelled, "target_period").select("supplier", "year", "label", "is_test")


@query(sql=f"""{SUPPLIERS_SQL}
    SELECT label, count(*) AS class_rows,
           (SELECT count(label) FROM labelled) / ((SELECT count(DISTINCT label) FROM labelled) * count(*)) AS class_weight
    FROM labelled WHERE label IS NOT NULL GROUP BY label""")
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    return forest.class_weights(lead_label(spark, d).filter("label IS NOT NULL"), "label")


@query(sql=f"""{SUPPLIERS_SQL},
    sold AS (
      SELECT l_suppkey AS supplier, CAST(year(l_shipdate) AS INT) AS year, CAST(sum(l_quantity) AS BIGINT) AS quantity,
             count(*) > 80 AS is_busy, count(*) FILTER (l_returnflag = 'R') AS n_returned
      FROM lineitem GROUP BY 1, 2),
    grown AS (SELECT *, lag(quantity) OVER (PARTITION BY supplier ORDER BY year) AS before FROM sold)
    SELECT supplier, year, label, CAST(is_busy AS DOUBLE) AS is_busy,
           {rnd("coalesce(CASE WHEN before IS NOT NULL THEN (quantity - before) / nullif(before, 0) END, -1)", 9)} AS growth,
           n_returned = 0 AS skipped
    FROM labelled JOIN grown USING (supplier, year)""")
def feature_prep(spark: SparkSession, d: str) -> DataFrame:
    """Flags as numbers, growth filled, and rows without a returned line skipped for want of a mean discount."""
    spec = replace(SPEC, filled=("growth",))
    prepared = forest.prepare_features(_suppliers(spark, d), spec)
    kept = forest.assemble(prepared, spec).drop("features").withColumn("skipped", F.lit(False))
    both = kept.unionByName(forest.skipped_rows(prepared, spec).withColumn("skipped", F.lit(True)))
    return both.select("supplier", "year", "label", "is_busy", F.round("growth", 9).alias("growth"), "skipped")


@query(sql="""
    SELECT l_suppkey AS supplier, CAST(max(year(l_shipdate)) + 1 AS INT) AS forecast_period, true AS tier_is_known,
           true AS confidence_is_possible
    FROM lineitem GROUP BY 1 HAVING max(year(l_shipdate)) = (SELECT max(year(l_shipdate)) FROM lineitem)""")
def rf_forecast(spark: SparkSession, d: str) -> DataFrame:
    """Next year's tier of every supplier active in the latest year.

    What the trees say depends on their samples; that every supplier gets one of the tiers, with a
    confidence that the best of four can have, does not.
    """
    run = forest.run_forest(_suppliers(spark, d), SPEC)
    confidence = F.col("prediction_confidence").between(1 / len(SPEC.labels), 1)
    return run.forecast.select(
        "supplier", "forecast_period", F.col("predicted_tier").isin(*SPEC.labels).alias("tier_is_known"),
        confidence.alias("confidence_is_possible"),
    )


# A table whose next tier follows from one feature, so that any sound forest gives the same answers.
PHASES = ForestSpec(
    entity="supplier", period="year", tier="phase_tier", features=("phase", "constant"), num_trees=20, labels=SPEC.labels,
)
PHASES_SQL = """
    WITH phases AS (
      SELECT DISTINCT l_suppkey AS supplier, CAST(year(l_shipdate) AS INT) AS year,
             CAST((l_suppkey + year(l_shipdate)) % 4 AS DOUBLE) AS phase FROM lineitem),
    labelled AS (SELECT *, lead(phase) OVER (PARTITION BY supplier ORDER BY year) AS label FROM phases),
    tested AS (
      SELECT label FROM labelled WHERE label IS NOT NULL
      AND year > (SELECT max(year) FROM labelled WHERE label IS NOT NULL) - 2)"""


def _phases(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers go through the tiers in turn, a tier each year (those active every year)."""
    years = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("supplier"), F.year("l_shipdate").alias("year")).distinct()
    phase = (F.col("supplier") + F.col("year")) % 4
    return years.select(
        "supplier", "year", phase.cast("double").alias("phase"), F.lit(1.0).alias("constant"),
        F.element_at(F.array(*[F.lit(t) for t in SPEC.labels]), (phase + 1).cast("int")).alias("phase_tier"),
    )


@query(sql=f"""{PHASES_SQL},
    classes AS (SELECT CAST(unnest([0, 1, 2, 3]) AS DOUBLE) AS label),
    counted AS (SELECT classes.label, count(tested.label) AS support FROM classes LEFT JOIN tested USING (label) GROUP BY 1)
    SELECT label, support, support AS predicted, support AS hits, CAST((support > 0)::INT AS DOUBLE) AS precision,
           CAST((support > 0)::INT AS DOUBLE) AS recall, CAST((support > 0)::INT AS DOUBLE) AS f1
    FROM counted""")
def rf_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """Precision, recall and F1 per tier on the two held-out years, where there is one right answer."""
    run = forest.run_forest(_phases(spark, d), PHASES)
    return classification_report(run.test_predictions, "label", "prediction", [0.0, 1.0, 2.0, 3.0])


@query(sql="SELECT 'phase' AS feature, 1e0 AS importance UNION ALL SELECT 'constant', 0e0")
def rf_importances(spark: SparkSession, d: str) -> DataFrame:
    """All depends on the one feature; rounded, as trees add up fractions."""
    run = forest.run_forest(_phases(spark, d), PHASES)
    return forest.importances(run.model, PHASES).withColumn("importance", F.round("importance", 9))
