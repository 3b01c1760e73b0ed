"""Gold panels brought up to date only where their sources changed.

What arrived in a source since a panel last read it touches entities in some periods. A panel looks back along an entity's rows,
never ahead, so of a touched entity the rows from its first touched period on may differ, and they need the sources
from the row before that (as many rows before as the panel looks back). Everything else stays as it is, and so do the
partitions it lies in. How far a panel has read its sources is part of its version, as in silver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.plans import gold
from panelkit.sources import versions
from panelkit.sources.feeds import INGESTED_AT
from panelkit.sources.tables import TableStore, checkpointed, overwrite_table, release

ENTITY, PERIOD = gold.PLACE_YEAR
SILVER = "silver"


@dataclass(frozen=True)
class Source:
    """A table that a panel is built from: which entity a row belongs to, and the periods that it counts for."""

    layer: str
    table: str
    entity: str = ENTITY
    first: Callable[[], Column] = lambda: F.col(PERIOD).cast("int")
    last: Callable[[], Column] | None = None

    @property
    def until(self) -> Column:
        return (self.last or self.first)()


@dataclass(frozen=True)
class Panel:
    """A gold table by entity and period, its sources in the order its function takes them, and how many rows it looks back."""

    table: str
    build: Callable[..., DataFrame]
    sources: Sequence[Source]
    rows_back: int = 0


def _year(column: str) -> Callable[[], Column]:
    return lambda: F.year(F.col(column).try_cast("date"))


_PERIOD = ("reference_period_start", "reference_period_end")
APPEALS = Source(SILVER, "funding", first=_year(_PERIOD[0]), last=_year(_PERIOD[1]))


def _silver(*tables: str) -> list[Source]:
    return [Source(SILVER, t) for t in tables]


#: From silver to the country facts, in the order in which they build on each other.
PANELS = (
    Panel("gold_conflict_features", gold.conflict_features, _silver("conflict_events")),
    Panel("gold_poverty_features", gold.poverty_features, _silver("povertyrate", "worldbank_mpm", "worldbank_extreme_poverty")),
    Panel("gold_food_security_features", gold.food_security_features, _silver("foodsecurity")),
    Panel("gold_funding_features", gold.funding_features, [APPEALS], rows_back=1),
    Panel(
        "gold_country_fact", gold.country_fact,
        [
            *[Source("gold", t) for t in (
                "gold_conflict_features", "gold_poverty_features", "gold_food_security_features", "gold_funding_features",
            )],
            *_silver("worldbank_population", "worldbank_gdp"),
            # A country's entry counts for all of its years.
            Source(SILVER, "location", "code", lambda: F.lit(0), lambda: F.lit(9999)),
        ],
        rows_back=1,
    ),
)


def touched_spans(
    changes: DataFrame, panel: DataFrame | None, rows_back: int, entity: str = ENTITY, period: str = PERIOD
) -> DataFrame:
    """Per touched entity ``_from``, its first touched period, and ``_since``, from where the sources are needed.

    ``changes`` are pairs of entity and period, repeated as often as they like. An entity has as many rows in the
    panel as there are periods, so looking back along them is a small window.
    """
    first = changes.filter(F.col(entity).isNotNull() & F.col(period).isNotNull()).groupBy(entity).agg(F.min(period).alias("_from"))
    if panel is None or not rows_back:
        return first.withColumn("_since", F.col("_from"))
    before = panel.select(entity, F.col(period).alias("_period")).join(first, entity).filter("_period < _from")
    back = before.groupBy(entity).agg(F.sort_array(F.collect_set("_period"), asc=False).alias("_before"))
    since = F.coalesce(F.get("_before", F.least(F.lit(rows_back), F.size("_before")) - 1), F.col("_from"))
    return first.join(back, entity, "left").select(entity, "_from", since.alias("_since"))


def within(rows: DataFrame, spans: DataFrame, source: Source, entity: str = ENTITY) -> DataFrame:
    """The rows of a source that count for a touched entity from its ``_since`` on."""
    spans = spans.select(F.col(entity).alias("_entity"), "_since")
    near = (F.col(source.entity) == F.col("_entity")) & (source.until >= F.col("_since"))
    return rows.join(spans, near, "left_semi")


def touched_rows(
    panel: Panel, inputs: Sequence[DataFrame], spans: DataFrame, entity: str = ENTITY, period: str = PERIOD
) -> DataFrame:
    """The panel's rows of the touched entities from their first touched period on, made of the parts of the inputs that count."""
    parts = [within(df, spans, source, entity) for df, source in zip(inputs, panel.sources)]
    starts = spans.select(F.col(entity).alias("_entity"), "_from")
    again = (F.col(entity) == F.col("_entity")) & (F.col(period) >= F.col("_from"))
    return panel.build(*parts).join(starts, again, "left_semi")


def _until(rows: DataFrame) -> int:
    """The newest time of ingestion in microseconds; -1 without rows."""
    found = rows.agg(F.max(F.unix_micros(INGESTED_AT))).first()[0]
    return -1 if found is None else found


def _pairs(rows: DataFrame, source: Source) -> DataFrame:
    """Entity and period that rows count for: only the first period, as everything from there on is made again."""
    earliest = F.least(source.first(), source.until)
    return rows.select(F.col(source.entity).alias(ENTITY), earliest.alias(PERIOD))


def refresh_panel(
    store: TableStore, panel: Panel, touched: Mapping[str, DataFrame], anew: bool = False
) -> DataFrame | None:
    """Bring one panel up to date; returns the pairs of entity and period that were made again, None if nothing is new.

    ``touched`` has those pairs for the panels among the sources that were refreshed before. Silver rows are new if they were
    ingested after what the panel's version says it has read. ``anew`` makes all rows, as the next version.
    """
    at = None if anew else store.version("gold", panel.table)
    old = versions.read(store.spark, store.path("gold", panel.table), at) if at else None
    inputs, changes, marks = [], [], {}
    for source in panel.sources:
        rows = store.read(source.layer, source.table)
        inputs.append(rows)
        if source.layer != SILVER:
            if at is None:
                changes.append(rows.select(ENTITY, PERIOD))
            elif source.table in touched:
                changes.append(touched[source.table])
            continue
        mark = f"{source.layer}/{source.table}"
        seen = at.marks.get(mark, {}).get(INGESTED_AT, -1) if at else -1
        new = rows.filter(F.col(INGESTED_AT) > F.timestamp_micros(F.lit(seen)))
        until = _until(new)
        if until > seen:
            marks[mark] = {INGESTED_AT: until}
            changes.append(_pairs(new, source))
    if not changes:
        return None
    spans = checkpointed(touched_spans(reduce(DataFrame.unionByName, changes), old, panel.rows_back))
    rows = checkpointed(touched_rows(panel, inputs, spans))
    release(spans)
    if anew:
        overwrite_table(rows, store.path("gold", panel.table), [PERIOD], marks)
    else:
        store.upsert(rows, "gold", panel.table, partition=PERIOD, mode="override", keys=[ENTITY, PERIOD], marks=marks)
    store.ensure_table("gold", panel.table)
    return rows.select(ENTITY, PERIOD)


def refresh_facts(store: TableStore, panels: Sequence[Panel] = PANELS, anew: bool = False) -> dict[str, DataFrame]:
    """Bring the feature tables and the country facts up to date with what is new in silver.

    The result is what making them from the whole of silver gives, as long as silver only gains and renews rows. After a
    refresh that takes rows away (``mode="replace"``) make them ``anew``. Returns the pairs made again by table; they
    are on disk until ``release``.
    """
    touched: dict[str, DataFrame] = {}
    for panel in panels:
        found = refresh_panel(store, panel, touched, anew)
        if found is not None:
            touched[panel.table] = found
    return touched
