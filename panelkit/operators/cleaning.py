"""Cleaning and conforming: NULL handling, latest versions, period columns, target schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.functions import null_if, strict_date
from panelkit.functions.text import ISO_PATTERN


def require_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep the rows in which every listed column is known."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def null_if_cast(df: DataFrame, columns: Iterable[str], to_type: str, placeholder: str = "-") -> DataFrame:
    """Turn the placeholder into NULL and cast the columns."""
    return df.withColumns({c: null_if(F.col(c).cast("string"), placeholder, to_type) for c in columns})


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


def latest_by(
    df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the newest by ``order``; NULL key parts form a key of their own.

    The filter on the row number lets Catalyst keep one candidate per key in every map task
    before the shuffle (WindowGroupLimit), so a key with most of the rows sends one row per task.
    Ties are broken by the given columns (largest first), by default by a hash of the whole row.
    """
    ties = [F.col(c).desc_nulls_last() for c in tiebreak] if tiebreak else [_row_hash(df).desc()]
    newest_first = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *ties)
    return df.withColumn("_version", F.row_number().over(newest_first)).filter("_version = 1").drop("_version")


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in a stated order."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def latest_value(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    oldest: str = "1900-01-01",
) -> DataFrame:
    """Values of the newest row per key, all taken from the same row; an unknown time is the oldest.

    The newest time per key comes from a hash aggregation, which combines before the shuffle, and goes back by
    a semi join that adaptive execution splits. Only rows of the newest time, mostly one per key, are then
    compared as a whole (by ``tiebreak``, then by value), which takes a sort.
    """
    when = F.coalesce(F.col(ts), F.lit(oldest).cast(df.schema[ts].dataType))
    rows = df.select(*keys, *[c for c in dict.fromkeys([*tiebreak, *values]) if c not in keys], when.alias("_ts"))
    newest = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max("_ts").alias("_newest"))
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(newest[f"_k_{k}"]) for k in keys])
    tied = rows.join(newest, same & (rows["_ts"] == newest["_newest"]), "left_semi")
    best = F.max(F.struct(*[F.col(c) for c in tiebreak], *[F.col(v).alias(f"_v_{v}") for v in values]))
    return tied.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, *[F.col(f"_best._v_{v}").alias(v) for v in values]
    )


def date_parts(df: DataFrame, column: str, pattern: str | None = ISO_PATTERN) -> DataFrame:
    """Add ``year``, ``month`` and ``day`` of an ISO string; NULL where it does not parse."""
    date = strict_date(F.col(column), pattern)
    return df.withColumns({"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)})


def explode_years(
    df: DataFrame, start: str, end: str, out: str = "year", pattern: str | None = ISO_PATTERN
) -> DataFrame:
    """One copy of the row for every calendar year its period touches.

    Periods with an unknown bound give no row; see ``unparsed_periods`` for them.
    """
    first, last = (F.year(strict_date(F.col(c), pattern)) for c in (start, end))
    return df.withColumn(out, F.explode(F.sequence(first, last)))


def unparsed_periods(df: DataFrame, start: str, end: str, pattern: str | None = ISO_PATTERN) -> DataFrame:
    """The rows that ``explode_years`` cannot place in any year."""
    return df.filter(
        strict_date(F.col(start), pattern).isNull() | strict_date(F.col(end), pattern).isNull()
    )


def fill_nulls(df: DataFrame, value: Any, columns: Sequence[str]) -> DataFrame:
    """Replace NULL by a constant in the listed columns."""
    return df.fillna(value, subset=list(columns))


def coalesce_columns(df: DataFrame, out: str, *sources: str) -> DataFrame:
    """First known value of several columns; the spare columns are dropped."""
    spare = [c for c in sources if c != out]
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in sources])).drop(*spare)


def conform(df: DataFrame, schema: StructType, overrides: Mapping[str, Column] | None = None) -> DataFrame:
    """Project onto a target schema: supplied expressions, else NULL of the target's type."""
    given = overrides or {}
    return df.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def tag(df: DataFrame, **constants: Any) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})
