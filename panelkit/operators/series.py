"""Operators along the time axis of a panel.

Every operator here demands one row per entity and period (aggregate first) and fails otherwise, so a
window partition never holds more rows than there are periods, whatever the size of the raw data.
All operators of a chain use the same partitioning and order: one shuffle, one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _along(keys: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def _single(keys: Sequence[str], order: str, value: Column) -> Column:
    """The value, or an error where the series has several rows of one period.

    Looks at the neighbour in the window that is there anyway.
    """
    repeated = F.lag(order).over(_along(keys, order)) == F.col(order)
    return F.when(repeated, F.raise_error(F.lit(f"a series holds several rows per {order}"))).otherwise(value)


def _is_next(keys: Sequence[str], order: str, n: int = 1) -> Column:
    """Whether the row n places back is exactly n periods back (NULL at the start of a series)."""
    return F.col(order) - F.lag(order, n).over(_along(keys, order)) == n


def lag_value(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    column: str,
    n: int = 1,
    guard_gap: bool = False,
    out: str | None = None,
) -> DataFrame:
    """Value n rows back; with ``guard_gap`` only if that row is also exactly n periods back."""
    value = F.lag(column, n).over(_along(keys, order))
    if guard_gap:
        value = F.when(_is_next(keys, order, n), value)
    return df.withColumn(out or f"{column}_lag{n}", _single(keys, order, value))


def lead_value(
    df: DataFrame, keys: Sequence[str], order: str, column: str, n: int = 1, out: str | None = None
) -> DataFrame:
    """Value n rows ahead."""
    value = F.lead(column, n).over(_along(keys, order))
    return df.withColumn(out or f"{column}_lead{n}", _single(keys, order, value))


def moving_avg(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    column: str,
    span: int = 3,
    digits: int | None = 0,
    out: str | None = None,
) -> DataFrame:
    """Mean over the last ``span`` periods by value of the period, so gaps shorten the window."""
    mean = F.avg(column).over(_along(keys, order).rangeBetween(-(span - 1), 0))
    mean = mean if digits is None else F.round(mean, digits)
    return df.withColumn(out or f"{column}_avg{span}", _single(keys, order, mean))


def yoy_growth(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    column: str,
    min_base: float = 1000,
    lag_out: str | None = None,
    growth_out: str | None = None,
    acceleration_out: str | None = None,
) -> DataFrame:
    """Growth in percent on the previous period, and the change of that growth.

    NULL unless the previous row is the previous period and its value reaches ``min_base``.
    """
    lag_out = lag_out or f"{column}_lag1"
    growth_out = growth_out or f"{column}_growth_pct"
    acceleration_out = acceleration_out or f"{column}_acceleration"
    along = _along(keys, order)
    base = F.col(lag_out)
    grown = df.withColumns({
        lag_out: _single(keys, order, F.lag(column, 1).over(along)),
        "_next": _is_next(keys, order),
    }).withColumn(
        growth_out,
        F.round(
            F.when(
                F.col("_next") & (F.abs(base) >= min_base),
                F.try_divide((F.col(column) - base) * F.lit(100.0), base.cast("double")),
            ),
            2,
        ),
    )
    change = F.col(growth_out) - F.lag(growth_out, 1).over(along)
    return grown.withColumn(acceleration_out, F.round(F.when(F.col("_next"), change), 2)).drop("_next")


def naive_projection(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    column: str,
    span: int = 3,
    average_out: str | None = None,
    projection_out: str | None = None,
    divergence_out: str | None = None,
) -> DataFrame:
    """Next value if the last step repeats (never below 0), and its distance from the moving average.

    NULL without a non-zero value in the previous period. A missing current value projects to 0.
    """
    average_out = average_out or f"{column}_avg{span}"
    projection_out = projection_out or f"{column}_projection"
    divergence_out = divergence_out or f"{column}_divergence_pct"
    value, average, projection = F.col(column), F.col(average_out), F.col(projection_out)
    lagged = moving_avg(df, keys, order, column, span, 0, average_out).withColumns({
        "_prev": F.lag(column, 1).over(_along(keys, order)),
        "_next": _is_next(keys, order),
    })
    repeated = F.greatest(F.lit(0), value + (value - F.col("_prev")))
    return (
        lagged.withColumn(projection_out, F.when(F.col("_next") & (F.col("_prev") != 0), repeated))
        .withColumn(
            divergence_out,
            F.round(F.try_divide(F.abs(projection - average) * F.lit(100.0), average), 1),
        )
        .drop("_prev", "_next")
    )
