"""String cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the timestamp layout of the feeds' reference periods.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"


def null_if(column: Column, placeholder: str = "-", to_type: str | None = None) -> Column:
    """NULL where the text is the placeholder; optionally cast what is left (bad text gives NULL)."""
    cleaned = F.nullif(column, F.lit(placeholder))
    return cleaned.try_cast(to_type) if to_type else cleaned


def strict_date(column: Column, pattern: str | None = ISO_PATTERN) -> Column:
    """Date of an ISO string, NULL where it does not match. ``pattern=None`` parses leniently."""
    if pattern is None:
        return column.try_cast("date")
    return F.try_to_date(column, pattern)
