"""Quality and summary reports, as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_report(
    df: DataFrame, entity: str, period: str, columns: Sequence[str], means: Sequence[str] = ()
) -> DataFrame:
    """One row: size, distinct entities, span of periods, known values per column, rounded means."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(entity).alias("distinct_entities"),
        F.min(period).alias("period_min"),
        F.max(period).alias("period_max"),
        *[F.count(c).alias(f"{c}_known") for c in columns],
        *[F.round(F.avg(c), 2).alias(f"{c}_mean") for c in means],
    )


def coverage_report(df: DataFrame, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """One row: percentage of rows in which each column is known."""
    rows = F.count(F.lit(1)).cast("double")
    return df.agg(*[
        F.round(F.try_divide(F.count(c).cast("double"), rows) * 100, digits).alias(c) for c in columns
    ])


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first (ties by value)."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_first(column))


def top(df: DataFrame, order: Sequence[str | Column], n: int = 20) -> DataFrame:
    """The first n rows in an order; each task keeps n rows, nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)


#: What ``summarise`` can say about a column (about rows and flags for the last three).
MEASURES = {
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "known": F.count,
    "rows": lambda _: F.count(F.lit(1)),
    "true": F.count_if,
    "true_pct": lambda flag: F.count_if(flag) * F.lit(100.0) / F.count(F.lit(1)),
}


def summarise(df: DataFrame, by: Sequence[str], measures: Mapping[str, Sequence]) -> DataFrame:
    """One row per group. ``measures`` maps an output to (measure, column) or (measure, column, digits)."""

    def column(measure: str, source: str, digits: int | None = None) -> Column:
        value = MEASURES[measure](source)
        return value if digits is None else F.round(value, digits)

    return df.groupBy(*by).agg(*[column(*what).alias(out) for out, what in measures.items()])


def _label_name(label) -> str:
    return str(int(label)) if isinstance(label, float) and label.is_integer() else str(label)


def confusion(df: DataFrame, actual: str, predicted: str, labels: Sequence) -> DataFrame:
    """Cross-tabulation: a row per actual label, a count column ``predicted_<label>`` per label.

    Labels may be of any type and are given, so the pivot needs no extra pass to find them.
    ``predicted_other`` counts the rows with another prediction or none.
    """
    guess = F.col(predicted)
    return df.groupBy(actual).agg(
        *[F.count_if(guess == label).alias(f"predicted_{_label_name(label)}") for label in labels],
        F.count_if(~F.coalesce(guess.isin(*labels), F.lit(False))).alias("predicted_other"),
    )


def classification_report(df: DataFrame, actual: str, predicted: str, labels: Sequence) -> DataFrame:
    """Precision, recall and F1 per label; a label never seen or never predicted scores 0.

    The hits, predictions and occurrences of all labels are counted in one aggregation.
    """
    a, p = F.col(actual), F.col(predicted)
    per_label = F.explode(F.array(*[
        F.struct(
            F.lit(label).alias("label"),
            F.col(f"_support_{i}").alias("support"),
            F.col(f"_predicted_{i}").alias("predicted"),
            F.col(f"_hits_{i}").alias("hits"),
        )
        for i, label in enumerate(labels)
    ]))
    counted = df.agg(*[
        F.count_if(condition).alias(f"_{name}_{i}")
        for i, label in enumerate(labels)
        for name, condition in (
            ("support", a == label),
            ("predicted", p == label),
            ("hits", (a == label) & (p == label)),
        )
    ])

    def share(numerator: Column, denominator: Column) -> Column:
        return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))

    return (
        counted.select(per_label.alias("_row"))
        .select("_row.*")
        .withColumns({
            "precision": share(F.col("hits"), F.col("predicted")),
            "recall": share(F.col("hits"), F.col("support")),
        })
        .withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )


def macro_f1(report: DataFrame) -> DataFrame:
    """Unweighted mean of F1 over the labels of a classification report."""
    return report.agg(F.avg("f1").alias("macro_f1"))
