"""Indicators on grouped data: conditional features, peaks, flags, funding, scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions import conditional_sum, count_known, preferred_max
from panelkit.operators.cleaning import latest_value
from panelkit.operators.series import lag_value


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def at_max_level(df: DataFrame, keys: Sequence[str], level: str) -> DataFrame:
    """Rows at the highest level found for their key.

    The levels come from an aggregation and go back by a semi join, so no task has to hold a
    whole key as a window partition would.
    """
    top = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max(level).alias("_top"))
    return df.join(top, _same(df, top, keys) & (df[level] == top["_top"]), "left_semi")


def category_features(
    df: DataFrame,
    keys: Sequence[str],
    level: str,
    category: str,
    features: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Conditional sums over the rows at a key's highest level; a NULL measure counts as 0.

    ``features`` maps an output to (category value, measure). Sums are taken per key and level
    first, then the highest level is picked among those few rows.
    """
    per_level = df.filter(F.col(level).isNotNull()).groupBy(*keys, level).agg(*[
        conditional_sum(F.col(category) == value, F.coalesce(F.col(measure), F.lit(0))).alias(out)
        for out, (value, measure) in features.items()
    ])
    return per_level.groupBy(*keys).agg(*[F.max_by(out, level).alias(out) for out in features])


def peak_by(df: DataFrame, keys: Sequence[str], measure: str, where: Column, out: str) -> DataFrame:
    """Largest value per key among the rows meeting a condition; keys without such rows give none."""
    return df.filter(where).groupBy(*keys).agg(F.max(measure).alias(out))


def any_flag(df: DataFrame, keys: Sequence[str], where: Column, out: str) -> DataFrame:
    """Whether any row of a key meets the condition; keys without rows give none."""
    return df.groupBy(*keys).agg(F.bool_or(F.coalesce(where, F.lit(False))).alias(out))


def needs_metrics(
    df: DataFrame,
    keys: Sequence[str],
    status: str,
    category: str,
    value: str,
    statuses: Mapping[str, str],
    total: str = "total",
) -> DataFrame:
    """Largest value per population status: of the total category, or else of rows without a category.

    ``statuses`` maps output columns to status codes.
    """
    name = F.col(category)
    unnamed = F.coalesce(name, F.lit("")) == ""
    columns = []
    for out, code in statuses.items():
        own = F.col(status) == code
        columns.append(preferred_max(F.col(value), own & (name == total), own & unnamed).alias(out))
    return df.groupBy(*keys).agg(*columns)


def response_gaps(df: DataFrame, needed: str, targeted: str, reached: str) -> DataFrame:
    """Unmet need: against the target, as a ratio to it, and against those reached."""
    need, target, done = F.col(needed), F.col(targeted), F.col(reached)
    return df.withColumns({
        "aid_gap": need - target,
        "aid_gap_ratio": F.round(F.try_divide(need.cast("double"), target.cast("double")), 3),
        "response_gap": F.when(done != 0, need - done),
    })


def appeal_funding(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    appeal: str,
    required: str,
    received: str,
    ts: str,
    tiebreak: Sequence[str] = (),
    anomalous_above: float = 100,
) -> DataFrame:
    """Funding against requirements per key and period, each appeal counted once (newest version).

    Only versions with a positive requirement count. Coverage is in percent.
    """
    newest = latest_value(
        df.filter(F.col(required) > 0), [*keys, period, appeal], [required, received], ts, tiebreak
    )
    totals = newest.groupBy(*keys, period).agg(
        F.count(appeal).alias("num_appeals"),
        F.sum(required).alias("total_required_usd"),
        F.sum(received).alias("total_received_usd"),
    )
    need, got = F.col("total_required_usd"), F.col("total_received_usd")
    covered = totals.withColumns({
        "funding_gap_usd": need - got,
        "funding_coverage_pct": F.round(F.try_divide(got * F.lit(100.0), need), 2),
    }).withColumn("is_funding_anomalous", F.col("funding_coverage_pct") > anomalous_above)
    return lag_value(
        covered, keys, period, "funding_coverage_pct", guard_gap=True, out="funding_coverage_lag1"
    )


def minmax_score(
    df: DataFrame,
    period: str,
    columns: Mapping[str, str],
    digits: int = 3,
    inverted: Sequence[str] = (),
) -> DataFrame:
    """Position of a value between the lowest and highest of its period, 0 to 1.

    ``columns`` maps outputs to source columns; those in ``inverted`` (outputs) score low values
    high. NULL where the value is missing or the period has no spread. The bounds are one small
    row per period, aggregated map-side and joined back, so a period with most of the rows is
    neither sorted nor gathered.
    """
    sources = list(dict.fromkeys(columns.values()))
    bounds = df.groupBy(F.col(period).alias(f"_k_{period}")).agg(
        *[F.min(c).alias(f"_min_{c}") for c in sources],
        *[F.max(c).alias(f"_max_{c}") for c in sources],
    )

    def score(out: str, c: str) -> Column:
        # As doubles, since the difference of two integers may not fit their type.
        value, low, high = (F.col(name).cast("double") for name in (c, f"_min_{c}", f"_max_{c}"))
        position = F.try_divide(value - low, high - low)
        return F.round(1 - position if out in inverted else position, digits)

    return (
        df.join(bounds, _same(df, bounds, [period]), "left")
        .withColumns({out: score(out, c) for out, c in columns.items()})
        .drop(*bounds.columns)
    )


def risk_profile(
    df: DataFrame, entity: str, period: str, directions: Mapping[str, bool], digits: int = 4
) -> DataFrame:
    """Scores of several variables within each period, 1 being worst, and how many are known.

    ``directions`` maps a variable to whether high values are worse.
    """
    scores = {f"score_{v}": v for v in directions}
    low_is_worse = [f"score_{v}" for v, high_is_worse in directions.items() if not high_is_worse]
    scored = minmax_score(df.select(entity, period, *directions), period, scores, digits, low_is_worse)
    return scored.select(
        entity, period, *scores, count_known(*[F.col(s) for s in scores]).alias("evaluable_dimensions")
    )
