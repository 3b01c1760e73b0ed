"""Panels brought up to date where their sources changed, against panels made of everything."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelkit.operators import lag_value
from panelkit.plans.incremental import Panel, Source, refresh_facts, touched_spans
from panelkit.sources import FEEDS
from tests.conftest import rows

ROWS = "location_code STRING, year INT, v INT, ingested_at TIMESTAMP"


def test_spans(frame):
    changes = frame("location_code STRING, year INT", ("a", 2005), ("a", 2003), ("b", 2001), ("c", 1990), (None, 2000), ("a", None))
    old = frame("location_code STRING, year INT", *[("a", y) for y in (1999, 2000, 2004)], ("b", 2001), ("d", 2000))
    for back, since in ((0, 2003), (1, 2000), (2, 1999), (5, 1999)):
        assert rows(touched_spans(changes, old, back), "location_code") == [("a", 2003, since), ("b", 2001, 2001), ("c", 1990, 1990)]
    assert rows(touched_spans(changes, None, 2).filter("_since <> _from")) == []


def yearly(df):
    """Sums with the one before and how it differs from the second before."""
    sums = df.groupBy("location_code", "year").agg(F.sum("v").alias("v"))
    lagged = lag_value(lag_value(sums, ["location_code"], "year", "v"), ["location_code"], "year", "v", n=2)
    return lagged.withColumn("change", F.col("v") - F.col("v_lag2"))


def test_as_made_of_everything(store, frame):
    rng, panel = random.Random(2), Panel("p", yearly, [Source("silver", "s")], rows_back=2)
    known = []
    for day in range(1, 6):
        touched = [rng.choice("abcdefgh") for _ in range(3 if day > 1 else 30)]
        known += [(k, rng.randint(2000, 2012), rng.randint(1, 9), datetime(2024, 1, day)) for k in touched]
        store.overwrite(frame(ROWS, *known), "silver", "s")
        made = refresh_facts(store, [panel])["p"]
        if day > 1:
            assert {r.location_code for r in made.collect()} <= set(touched)
        columns = ["location_code", "year", "v", "v_lag1", "v_lag2", "change"]
        assert rows(store.read("gold", "p").select(*columns), "location_code", "year") == rows(
            yearly(frame(ROWS, *known)).select(*columns), "location_code", "year"
        )
    before = store.version("gold", "p")
    assert refresh_facts(store, [panel]) == {} and store.version("gold", "p") == before
    assert before.marks == {"silver/s": {"ingested_at": int(datetime(2024, 1, 5).timestamp() * 1e6)}}


def test_years_that_nothing_touched_stay_where_they_are(store, frame):
    panel = Panel("p", yearly, [Source("silver", "s")], rows_back=2)
    first = [("a", y, 1, datetime(2024, 1, 1)) for y in range(2000, 2010)]
    store.overwrite(frame(ROWS, *first), "silver", "s")
    refresh_facts(store, [panel])
    folders = set(store.version("gold", "p").folders)
    store.overwrite(frame(ROWS, *first, ("a", 2008, 5, datetime(2024, 1, 2))), "silver", "s")
    refresh_facts(store, [panel])
    kept = {f.partition("/")[2] for f in folders & set(store.version("gold", "p").folders)}
    assert kept == {f"year={y}" for y in range(2000, 2008)}


def test_feeds_have_the_columns_that_sources_name():
    from panelkit.plans.incremental import APPEALS, PANELS, SILVER

    tables = {f.table: f.silver_schema.names for f in FEEDS.values()}
    for panel in PANELS:
        for source in panel.sources:
            if source.layer == SILVER:
                assert source.entity in tables[source.table] and "ingested_at" in tables[source.table]
                assert source.table == "location" or source == APPEALS or "year" in tables[source.table]


def test_override_needs_keys_and_wins_whatever_its_age(store, frame):
    old = [("a", 2000, 1, datetime(2024, 1, 2)), ("b", 2000, 2, datetime(2024, 1, 2)), (None, 2000, 3, datetime(2024, 1, 2))]
    store.upsert(frame(ROWS, *old), "gold", "t", mode="override", keys=["location_code", "year"])
    batch = frame(ROWS, ("a", 2000, 9, datetime(2024, 1, 1)), (None, 2000, 8, datetime(2024, 1, 1)))
    store.upsert(batch, "gold", "t", mode="override", keys=["location_code", "year"])
    assert rows(store.read("gold", "t").select("location_code", "v"), "v") == [("b", 2), (None, 8), ("a", 9)]
    with pytest.raises(ValueError, match="keys"):
        store.upsert(batch, "gold", "t", mode="override")


def test_rows_that_went_are_gone_when_made_anew(store, frame):
    panel = Panel("p", yearly, [Source("silver", "s")], rows_back=2)
    rows_of = lambda *k: frame(ROWS, *[(x, y, 1, datetime(2024, 1, 1)) for x in k for y in range(2000, 2004)])
    store.overwrite(rows_of("a", "b"), "silver", "s")
    refresh_facts(store, [panel])
    reader = store.read("gold", "p")
    store.overwrite(rows_of("b"), "silver", "s")
    assert refresh_facts(store, [panel]) == {}
    refresh_facts(store, [panel], anew=True)
    assert rows(store.read("gold", "p").select("location_code").distinct()) == [("b",)]
    assert reader.count() == 8 and store.version("gold", "p").number == 2
    assert refresh_facts(store, [panel]) == {}
