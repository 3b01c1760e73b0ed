"""Queries over the driver tables, each next to the SQL that must give the same rows."""

from parity import cleaning, gold, indicators, panels, reports, series  # noqa: F401  (registers queries)
from parity import lake  # noqa: F401, I001  (whose SQL is that of queries above)
from parity.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
