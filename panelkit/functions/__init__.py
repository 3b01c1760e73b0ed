"""Column expressions shared by the operators. All stay inside Catalyst."""

from panelkit.functions.encoding import TIERS, decode_tier, encode_tier, tier
from panelkit.functions.measures import (
    conditional_sum,
    count_known,
    count_true,
    effective_flag,
    gap_ratio,
    growth_rate,
    guarded_ratio,
    log_index,
    per_capita,
    ratio,
    preferred_max,
)
from panelkit.functions.text import null_if, strict_date

__all__ = [
    "TIERS",
    "conditional_sum",
    "count_known",
    "count_true",
    "decode_tier",
    "effective_flag",
    "encode_tier",
    "gap_ratio",
    "growth_rate",
    "guarded_ratio",
    "log_index",
    "null_if",
    "per_capita",
    "ratio",
    "preferred_max",
    "strict_date",
    "tier",
]
