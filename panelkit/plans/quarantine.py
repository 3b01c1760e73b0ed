"""What the refresh sets aside, kept as text with its origin, so that nothing is lost without notice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.allocation import rejected_periods
from panelkit.operators.cleaning import require_not_null, unparsed_periods
from panelkit.operators.forest import ForestSpec, prepare_features, skipped_rows
from panelkit.plans.silver import BRONZE, unread_batches
from panelkit.sources import batches
from panelkit.sources.feeds import BAD_RECORD, FEEDS, INGESTED_AT, INGESTED_ON, UNKNOWN, FeedSpec
from panelkit.sources.records import read_since
from panelkit.sources.tables import TableStore
from panelkit.sources.versions import Marks, Version

LAYER, TABLE = "quarantine", "rejected"
_PERIOD = ("reference_period_start", "reference_period_end")


def rejected(rows: DataFrame, source: str) -> DataFrame:
    """Rows set aside, each as a JSON text, under the name of where and why."""
    return rows.select(
        F.lit(source).alias("source"), F.to_json(F.struct("*")).alias("record"), F.current_timestamp().alias("rejected_at")
    )


def _new_bronze(store: TableStore, feed: FeedSpec, at: Version | None, since) -> tuple[DataFrame | None, Marks]:
    """The raw rows of a feed that quarantine has not looked at, or those since a time; and how far it has looked then."""
    mark, path = f"{BRONZE}/{feed.table}", store.path(BRONZE, feed.table)
    if since is not None:
        return read_since(store.read(BRONZE, feed.table, feed.bronze_schema), since=since), {}
    found = unread_batches(store, feed, at, mark)
    if not found:
        return None, {}
    return batches.read(store.spark, path, feed.bronze_schema, found), {mark: batches.marks_of(found)}


def refresh_quarantine(store: TableStore, since=None, pressure: tuple[str, ForestSpec] | None = None) -> None:
    """Add what was set aside of the records that came since the last refresh (or a time), and by the later steps.

    Bad JSON and periods without a year come from bronze, reversed periods from the appeals, rows without the
    features of the forest from the pressure table (its name and the forest's settings). Which batches of bronze and which
    appeals it has looked at is part of the table's version, so each is looked at once, and only the sources
    with something new are written. Kept by source and text: running it again adds nothing.
    """
    parts, marks, at = [], {}, store.version(LAYER, TABLE)
    for feed in FEEDS.values():
        if not store.exists(BRONZE, feed.table):
            continue
        bronze, seen = _new_bronze(store, feed, at, since)
        marks |= seen
        if bronze is None:
            continue
        bad = bronze.filter(F.col(BAD_RECORD).isNotNull()).select(BAD_RECORD)
        parts.append(rejected(bad, f"{feed.table}.bad_json"))
        good = require_not_null(
            bronze.filter(F.col(BAD_RECORD).isNull()), feed.not_null
        ).drop(BAD_RECORD, UNKNOWN, INGESTED_ON, INGESTED_AT)
        if feed.year_rule == "period_span":
            parts.append(rejected(unparsed_periods(good, *_PERIOD), f"{feed.table}.unparsed_period"))
    if store.exists("silver", "funding"):
        mark = "silver/funding"
        seen = at.marks.get(mark, {}).get(INGESTED_AT, -1) if at and since is None else -1
        appeals = store.read("silver", "funding").filter(F.col(INGESTED_AT) > F.timestamp_micros(F.lit(seen)))
        until = appeals.agg(F.max(F.unix_micros(INGESTED_AT))).first()[0]
        if until is not None:
            marks[mark] = {INGESTED_AT: until}
            parts.append(rejected(rejected_periods(appeals.drop(INGESTED_AT), *_PERIOD), "funding.reversed_period"))
    if pressure and store.exists("gold", pressure[0]):
        observed = store.read("gold", pressure[0], is_forecast="boolean").filter(~F.col("is_forecast"))
        parts.append(rejected(skipped_rows(prepare_features(observed, pressure[1]), pressure[1]), "forest.skipped_row"))
    if parts:
        rows = reduce(DataFrame.unionByName, parts)
        if at is not None:
            # A record that is there already, with the time it was first set aside, stays as it is.
            known = store.read(LAYER, TABLE).select("source", F.xxhash64("record").alias("_hash"), "record")
            rows = rows.withColumn("_hash", F.xxhash64("record")).join(known, ["source", "_hash", "record"], "left_anti").drop("_hash")
        store.upsert(rows, LAYER, TABLE, partition="source", keys=["source", "record"], order="rejected_at", marks=marks)
