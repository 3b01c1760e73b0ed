"""Reports that are put together from one row per partition of a table.

Counts, bounds and sums of partitions add up to those of the table, and so do sketches of distinct values. When some
partitions change, only their rows are made again. Where an estimate of distinct values will not do, pairs of
partition and value are kept besides, which are few next to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the number of cells in a sketch of distinct values; its error is about 1.04 / sqrt(cells).
SKETCH_BITS = 14


def partial_report(
    df: DataFrame, part: str, columns: Sequence[str], entity: str | None = None, period: str | None = None, means: Sequence[str] = ()
) -> DataFrame:
    """One row per partition: rows, known values per column, bounds of the period, sums, and a sketch of the entities."""
    return df.groupBy(part).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(c).alias(f"{c}_known") for c in dict.fromkeys([*columns, *means])],
        *([F.min(period).alias("period_min"), F.max(period).alias("period_max")] if period else []),
        *[F.sum(F.col(c).cast("double")).alias(f"{c}_sum") for c in means],
        *([F.hll_sketch_agg(F.col(entity).cast("string"), F.lit(SKETCH_BITS)).alias("entities")] if entity else []),
    )


def entity_pairs(df: DataFrame, part: str, entity: str) -> DataFrame:
    """The known entities of each partition, for counts of distinct ones that are exact."""
    return df.filter(F.col(entity).isNotNull()).select(part, F.col(entity).cast("string").alias("entity")).distinct()


def _known(column: str) -> Column:
    return F.coalesce(F.sum(f"{column}_known"), F.lit(0))


def merged_quality(
    partials: DataFrame, columns: Sequence[str], means: Sequence[str] = (), pairs: DataFrame | None = None
) -> DataFrame:
    """The ``quality_report`` of the table; distinct entities are estimated unless their ``pairs`` are given."""
    entities = F.hll_sketch_estimate(F.hll_union_agg("entities")) if pairs is None else pairs.agg(F.count_distinct("entity")).scalar()
    merged = partials.agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
        *([F.coalesce(entities, F.lit(0)).alias("distinct_entities")] if pairs is None else []),
        F.min("period_min").alias("period_min"),
        F.max("period_max").alias("period_max"),
        *[_known(c).alias(f"{c}_known") for c in columns],
        *[F.round(F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_known")), 2).alias(f"{c}_mean") for c in means],
    )
    return merged if pairs is None else merged.withColumn("distinct_entities", entities)


def merged_coverage(partials: DataFrame, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """The ``coverage_report`` of the table."""
    rows = F.sum("total_rows").cast("double")
    return partials.agg(*[F.round(F.try_divide(_known(c).cast("double"), rows) * 100, digits).alias(c) for c in columns])
