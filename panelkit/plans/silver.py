"""Bronze to silver: clean, keep the newest version per business key, place in years."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelkit.operators.cleaning import (
    date_parts,
    explode_years,
    latest_by,
    null_if_cast,
    require_not_null,
)
from panelkit.sources import batches
from panelkit.sources.feeds import BAD_RECORD, FEEDS, INGESTED_ON, UNKNOWN, FeedSpec
from panelkit.sources.records import read_since, typed_fields
from panelkit.sources.tables import TableStore, between_years
from panelkit.sources.versions import Version


def refine(bronze: DataFrame, feed: FeedSpec) -> DataFrame:
    """The silver rows of a batch of bronze rows; fields that came before the feed's schema had them are among them."""
    if UNKNOWN in bronze.columns:
        bronze = typed_fields(bronze, feed.schema, feed.mapping, UNKNOWN)
    rows = bronze.drop(BAD_RECORD, UNKNOWN, INGESTED_ON)
    if feed.placeholder_ints:
        rows = null_if_cast(rows, feed.placeholder_ints, "int")
    rows = latest_by(require_not_null(rows, feed.not_null), feed.keys, "ingested_at")
    if feed.year_rule == "period_start":
        return date_parts(rows, "reference_period_start")
    if feed.year_rule == "period_span":
        return explode_years(rows, "reference_period_start", "reference_period_end")
    return rows


BRONZE = "bronze"


def unread_batches(store: TableStore, feed: FeedSpec, reader: Version | None, source: str) -> list[str]:
    """The batches of a feed's raw table that a table has not taken in, going by the marks in its version."""
    marks = reader.marks.get(source, {}) if reader else {}
    return batches.unread(batches.names(store.spark, store.path(BRONZE, feed.table)), marks)


def refresh_silver(
    store: TableStore, feed: FeedSpec, since=None, mode: str = "merge", years: tuple[int, int] | None = None, **options
) -> None:
    """Bring a feed's silver table up to date with every batch that it has not taken in yet.

    How far it has come is part of the table's version, so it moves with the rows or not at all: a day without a
    run, a run over midnight or one that is killed anywhere leaves nothing out and takes nothing in twice.

    ``since`` reads what arrived from a time on instead, as after a change of the cleaning rules. ``mode="merge"`` keeps older keys of
    the years a batch touches, ``"replace"`` lets the batch replace those years. ``years`` (first and last) takes only
    rows of those, as for a backfill. Neither of these moves the mark. The table is entered in the catalog. ``options`` are
    those of ``upsert_partitions``.
    """
    path, marks = store.path(BRONZE, feed.table), None
    if since is None:
        found = unread_batches(store, feed, store.version("silver", feed.table), BRONZE)
        if not found:
            return
        bronze = batches.read(store.spark, path, feed.bronze_schema, found)
        marks = None if years else {BRONZE: batches.marks_of(found)}
    else:
        bronze = read_since(store.read(BRONZE, feed.table, feed.bronze_schema), since=since)
    rows = refine(bronze, feed)
    if years and "year" in rows.columns:
        rows = between_years(rows, *years)
    store.upsert(rows, "silver", feed.table, mode=mode, keys=_table_keys(feed), schema=feed.silver_schema, marks=marks, **options)
    if store.exists("silver", feed.table):
        store.ensure_table("silver", feed.table)


def _table_keys(feed: FeedSpec) -> tuple[str, ...]:
    return feed.keys if "year" in feed.keys or feed.year_rule == "none" else (*feed.keys, "year")


def refresh_all_silver(
    store: TableStore, since=None, mode: str = "merge", years: tuple[int, int] | None = None
) -> None:
    """Every feed that has bronze data."""
    for feed in FEEDS.values():
        if store.exists("bronze", feed.table):
            refresh_silver(store, feed, since, mode, years)
