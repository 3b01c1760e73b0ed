"""Feeds, raw records and tables."""

from panelkit.sources.feeds import FEEDS, FeedSpec
from panelkit.sources.records import (
    parse_json_records,
    read_since,
    stamp_ingested,
    typed_fields,
    unreadable_pages,
    unwrap_records,
)
from panelkit.sources.tables import TableStore, between_years, checkpointed, checkpoint_dir

__all__ = [
    "FEEDS",
    "FeedSpec",
    "TableStore",
    "between_years",
    "checkpoint_dir",
    "checkpointed",
    "parse_json_records",
    "read_since",
    "stamp_ingested",
    "typed_fields",
    "unreadable_pages",
    "unwrap_records",
]
