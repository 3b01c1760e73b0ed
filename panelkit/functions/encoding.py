"""Fixed-threshold tiers and their ordinal encoding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier names from least to most severe; the position is the class label.
TIERS = ("Low", "Medium", "High", "Critical")


def tier(
    value: Column,
    bounds: Sequence[float],
    labels: Sequence[str] = TIERS,
    inclusive: bool = False,
) -> Column:
    """Label of the first bound the value stays below (or on, if inclusive); NULL stays NULL."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need exactly one more label than bounds")
    case = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        case = case.when(value <= bound if inclusive else value < bound, label)
    return case.otherwise(labels[-1])


def encode_tier(label: Column, labels: Sequence[str] = TIERS) -> Column:
    """Position of the label as a double; unknown labels and NULL give NULL."""
    cases = [(label == name, float(i)) for i, name in enumerate(labels)]
    return reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), cases[1:], F.when(cases[0][0], F.lit(cases[0][1])))


def decode_tier(code: Column, labels: Sequence[str] = TIERS) -> Column:
    """Label at a position; anything outside the range gives NULL."""
    cases = [(code == float(i), name) for i, name in enumerate(labels)]
    return reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), cases[1:], F.when(cases[0][0], F.lit(cases[0][1])))
