"""Spreading amounts over calendar years."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bounds(df: DataFrame, start: str, end: str) -> tuple[Column, Column]:
    return tuple(
        F.col(c) if df.schema[c].dataType.typeName() == "date" else F.col(c).try_cast("date")
        for c in (start, end)
    )


def prorate_by_year(
    df: DataFrame, start: str, end: str, amounts: Mapping[str, str], out: str = "year"
) -> DataFrame:
    """One row per calendar year of a period, with the amounts shared out by days.

    A period within one year keeps its full amount; otherwise a year gets the share of the
    period's days (both ends included) that fall into it. ``amounts`` maps output to source
    columns. The days come from the overlap of two intervals, so a period costs one row per
    year rather than one per day. Rows of ``rejected_periods`` are left out.
    """
    first, last = _bounds(df, start, end)
    dated = df.withColumns({"_first": first, "_last": last}).filter(F.year("_first") <= F.year("_last"))
    yearly = dated.withColumn(out, F.explode(F.sequence(F.year("_first"), F.year("_last"))))
    from_day = F.greatest(F.col("_first"), F.make_date(F.col(out), F.lit(1), F.lit(1)))
    to_day = F.least(F.col("_last"), F.make_date(F.col(out), F.lit(12), F.lit(31)))
    days, total = F.datediff(to_day, from_day) + 1, F.datediff(F.col("_last"), F.col("_first")) + 1
    share = F.when(F.year("_first") == F.year("_last"), F.lit(1.0)).otherwise(days / total)
    return yearly.withColumns({name: share * F.col(c) for name, c in amounts.items()}).drop("_first", "_last")


def rejected_periods(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows without a usable period: a bound is missing or the end lies in an earlier year."""
    first, last = _bounds(df, start, end)
    return df.filter(~F.coalesce(F.year(first) <= F.year(last), F.lit(False)))
