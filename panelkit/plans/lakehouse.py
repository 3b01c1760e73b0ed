"""Refreshing the whole lakehouse in dependency order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import decode_tier
from panelkit.operators.forest import ForestRun, ForestSpec, importances
from panelkit.operators.partials import merged_coverage
from panelkit.operators.reports import (
    classification_report,
    confusion,
    distribution,
    macro_f1,
    quality_report,
    summarise,
)
from panelkit.plans import gold
from panelkit.plans.incremental import refresh_facts
from panelkit.plans.quarantine import refresh_quarantine
from panelkit.plans.silver import refresh_all_silver
from panelkit.plans.summaries import refresh_partials
from panelkit.sources.feeds import FEEDS
from panelkit.sources.tables import TableStore, checkpointed, release
from panelkit.streaming.ingest import start_ingest

PRESSURE_TABLE = "gold_host_pressure_indices"
BY_TABLE = {feed.table: feed for feed in FEEDS.values()}


def refresh_bronze(store: TableStore, source: str, options: Mapping[str, Mapping[str, str]]) -> None:
    """Ingest what is new for each feed named in ``options`` (feed topic to source options), all at once."""
    running = [start_ingest(store, FEEDS[topic], source, own) for topic, own in options.items()]
    for query in running:
        query.awaitTermination()


def _silver(store: TableStore, name: str) -> DataFrame:
    return store.read("silver", name, BY_TABLE[name].silver_schema)


def _publish(
    store: TableStore, name: str, df: DataFrame, partition_by: Sequence[str] = (), layer: str = "gold"
) -> DataFrame:
    """Write a table, enter it in the catalog and read it back with the schema it was written with."""
    schema = df.schema
    store.overwrite(df, layer, name, partition_by)
    store.ensure_table(layer, name)
    return store.read(layer, name, None if partition_by else schema)


def refresh_features(store: TableStore, anew: bool = False) -> None:
    """Feature tables and country facts where silver has changed, then displacement, hosts and their pressure.

    ``anew`` makes the facts from the whole of silver, as after a refresh that took rows away.
    """

    def silver(name):
        return _silver(store, name)

    def publish(name, df, partition_by=()):
        return _publish(store, name, df, partition_by)

    for made in refresh_facts(store, anew=anew).values():
        release(made)
    displaced = publish("gold_displacement", gold.displacement(silver("population"), silver("solutions")))
    hosts = publish("gold_host_aggregates", gold.host_aggregates(displaced))
    facts = store.read("gold", "gold_country_fact")
    publish(PRESSURE_TABLE, gold.host_pressure_indices(hosts, facts), ["is_forecast"])


def refresh_pressure_forecast(store: TableStore, spec: ForestSpec = gold.PRESSURE_FOREST) -> ForestRun:
    """Replace the forecast rows of the pressure table by a new forecast."""
    indices = store.read("gold", PRESSURE_TABLE, is_forecast="boolean")
    run, rows = gold.pressure_forecast(indices, spec)
    store.replace_slice(rows, "gold", PRESSURE_TABLE, "is_forecast", True)
    store.ensure_table("gold", PRESSURE_TABLE)
    return run


def refresh_aid(store: TableStore) -> None:
    """Aid demand, its trends, their validation and the risk profile."""
    tables = (
        "population", "solutions", "humanitarian_needs", "conflict_events", "foodsecurity", "funding",
        "worldbank_gdp", "worldbank_mpm", "worldbank_extreme_poverty", "worldbank_population",
    )
    population, solutions, needs, *others = (_silver(store, t) for t in tables)
    gaps = checkpointed(gold.needs_gaps(needs))
    aid = _publish(store, "aid_demand_analysis", gold.aid_demand(population, solutions, gaps, *others))
    release(gaps)
    _publish(store, "trend_forecast", gold.trend_forecast(aid))
    _publish(store, "model_validation", gold.model_validation(aid))
    _publish(store, "risk_profile", gold.risk_profile(aid))


def refresh_reports(store: TableStore, run: ForestRun | None = None, spec: ForestSpec = gold.PRESSURE_FOREST) -> None:
    """What the tables hold and how good the models are, as tables of the layer ``reports``."""

    def publish(name, df):
        _publish(store, name, df, layer="reports")

    facts, aid = store.version("gold", "gold_country_fact"), store.read("gold", "aid_demand_analysis")
    measured = [c for c in facts.schema.names if c not in gold.PLACE_YEAR]
    partials, _ = refresh_partials(store, "gold", "gold_country_fact", measured)
    publish("country_fact_coverage", merged_coverage(partials, measured))
    publish("aid_quality", quality_report(aid, "location_code", "year", list(gold.RISK_DIRECTIONS)))
    indices = store.read("gold", PRESSURE_TABLE, is_forecast="boolean").filter(~F.col("is_forecast"))
    for column in ("pressure_per_capita_tier", "pressure_per_gdp_per_capita_tier", "funding_gap_tier"):
        publish(f"{column}_distribution", distribution(indices, column))
    publish("trend_quality", summarise(store.read("gold", "trend_forecast"), ["variable_name"], gold.TREND_SUMMARY))
    publish(
        "validation_quality",
        summarise(store.read("gold", "model_validation"), ["variable_name"], gold.VALIDATION_SUMMARY)
    )
    if run is not None:
        labels = [float(i) for i in range(len(spec.labels))]
        tested = checkpointed(run.test_predictions.select("label", "prediction", spec.tier, "predicted_tier"))
        report = classification_report(tested, "label", "prediction", labels)
        publish("pressure_classification", report)
        publish("pressure_macro_f1", macro_f1(report))
        actual = tested.withColumn("actual_tier", decode_tier(F.col("label"), spec.labels))
        publish("pressure_confusion", confusion(actual, "actual_tier", "predicted_tier", spec.labels))
        publish("pressure_importances", importances(run.model, spec))
        release(tested)


def refresh_all(store: TableStore, since=None, mode: str = "merge", years: tuple[int, int] | None = None) -> None:
    """Silver, gold, reports and quarantine from whatever bronze holds.

    ``years`` (first and last) limits the rows that go to silver, as for a backfill.
    """
    refresh_all_silver(store, since, mode, years)
    refresh_features(store, anew=mode == "replace")
    run = refresh_pressure_forecast(store)
    refresh_aid(store)
    refresh_reports(store, run)
    refresh_quarantine(store, since, (PRESSURE_TABLE, gold.PRESSURE_FOREST))
