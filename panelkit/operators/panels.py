"""Building panels: outer skeletons, enrichment, key filters, dense grids."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.cleaning import require_not_null


def outer_panel(sources: Sequence[DataFrame], keys: Sequence[str], anchors: Sequence[int] = ()) -> DataFrame:
    """Full outer join of sources that hold each key at most once and share no other column.

    Done as one union and one aggregation: a single shuffle with map-side combine however many
    sources there are, where a chain of outer joins shuffles the growing side again each time.
    Keys with a NULL part match nothing, as in a join: each such row stays by itself. A key that a source holds
    twice is an error, found by counts in the same aggregation. With ``anchors`` (positions of
    sources), only keys found in one of those are kept, which makes the others left joins.
    """
    values = [[c for c in s.columns if c not in keys] for s in sources]
    names = [c for cols in values for c in cols]
    if len(set(names)) != len(names):
        raise ValueError("sources of an outer panel must not share value columns")
    no_match = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rows = [
        s.select(
            *keys,
            F.when(no_match, F.lit(i)).alias("_alone"),
            F.when(no_match, F.monotonically_increasing_id()).alias("_row"),
            F.lit(i in anchors).alias("_anchor"),
            F.lit(1).alias(f"_in_{i}"),
            *cols,
        )
        for i, (s, cols) in enumerate(zip(sources, values))
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    panel = stacked.groupBy(*keys, "_alone", "_row").agg(
        F.bool_or("_anchor").alias("_anchor"),
        *[F.sum(f"_in_{i}").alias(f"_in_{i}") for i in range(len(sources))],
        *[F.max(c).alias(c) for c in names],
    )
    repeated = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"_in_{i}"), F.lit(0)) > 1 for i in range(len(sources))])
    error = F.raise_error(F.concat(F.lit("a source of the panel repeats the key "), F.to_json(F.struct(*keys))))
    panel = panel.filter(
        F.when(repeated, error.cast("boolean")).otherwise(F.col("_anchor") if anchors else F.lit(True))
    )
    return panel.select(*keys, *names)


def enrich(df: DataFrame, dimensions: Iterable[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left joins on the same keys; Spark broadcasts a dimension if its measured size allows."""
    return reduce(lambda acc, dim: acc.join(dim, list(keys), "left"), dimensions, df)


def semi_filter(df: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in another frame.

    Duplicates there neither matter nor multiply rows. Better leave them in: removing them first
    is one more shuffle, and keeps adaptive execution from splitting a key with many rows here.
    """
    return df.join(allowed.select(*keys), list(keys), "left_semi")


def union_distinct(frames: Sequence[DataFrame], columns: Sequence[Sequence[str]], out: Sequence[str]) -> DataFrame:
    """Distinct rows of several frames, columns matched by position."""
    parts = [f.select(*[F.col(c).alias(o) for c, o in zip(cols, out)]) for f, cols in zip(frames, columns)]
    return reduce(DataFrame.union, parts).distinct()


def densify(
    df: DataFrame,
    entity: str,
    period: str,
    fills: Mapping[str, Any],
    entities: DataFrame | None = None,
    span: DataFrame | None = None,
) -> DataFrame:
    """Every entity in every period between the first and the last of the whole frame.

    The frame holds one row per entity and period. Columns in ``fills`` get their constant where
    missing. ``entities`` (one row per entity, with any attributes to carry along) says which
    entities the grid has; by default all of the frame. ``span`` is any frame with the same range
    of periods; giving the rows the frame was aggregated from spares aggregating them once more
    for the bounds. The two bounds are scalar subqueries, so the grid itself needs no join.
    """
    bounds = (df if span is None else span).agg(
        F.min(period).cast("int").alias("lo"), F.max(period).cast("int").alias("hi")
    )
    periods = F.sequence(bounds.select("lo").scalar(), bounds.select("hi").scalar())
    members = df.select(entity).distinct() if entities is None else entities
    grid = members.select("*", F.explode(periods).alias(period))
    return grid.join(df, [entity, period], "left").fillna(dict(fills))


def averages_panel(sources: Sequence[tuple[DataFrame, Mapping[str, str]]], keys: Sequence[str]) -> DataFrame:
    """Means of several sources side by side for every key found in any of them.

    ``sources`` pairs a frame with {output column: source column}. Rows with an unknown key
    are left out. A mean ignores NULL, so the sources can be stacked and averaged in one pass.
    """
    rows = [require_not_null(s, keys).select(*keys, *[F.col(c).alias(o) for o, c in cols.items()]) for s, cols in sources]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.groupBy(*keys).agg(*[F.avg(o).alias(o) for _, cols in sources for o in cols])


def sum_with_labels(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], labels: Sequence[str] = ()
) -> DataFrame:
    """Sums per key together with one known label per label column (the smallest).

    A minimum over text cannot be hash-aggregated, so the rows are first summed by key and label
    with a hash aggregation; only that small result is reduced to one row per key.
    """
    totals = [c.alias(name) for name, c in sums.items()]
    if not labels:
        return df.groupBy(*keys).agg(*totals)
    by_label = df.groupBy(*keys, *labels).agg(*totals)
    return by_label.groupBy(*keys).agg(
        *[F.min(label).alias(label) for label in labels], *[F.sum(name).alias(name) for name in sums]
    )
