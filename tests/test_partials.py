"""Reports from partial ones against reports of the whole table."""

import pytest
from pyspark.sql import functions as F

from panelkit.operators import coverage_report, quality_report
from panelkit.operators.partials import merged_coverage, merged_quality, partial_report
from panelkit.plans import summaries
from panelkit.plans.summaries import refresh_partials
from tests.conftest import rows

ROWS = "k STRING, v INT, w DOUBLE, year INT"
OPTIONS = {"columns": ["v", "w"], "entity": "k", "period": "year", "means": ["v"]}


def data(first, last, step=1):
    return [
        (None if i % 11 == 0 else f"k{i % 37}", None if i % 5 == 0 else i, i / 3 if i % 2 else None, y)
        for y in range(first, last) for i in range(0, 90, step)
    ]


def both(store):
    whole = store.read("gold", "t")
    wanted = rows(quality_report(whole, "k", "year", ["v", "w"], ["v"])), rows(coverage_report(whole, ["v", "w"]))
    partials, pairs = refresh_partials(store, "gold", "t", exact=True, **OPTIONS)
    merged = merged_quality(partials, ["v", "w"], ["v"], pairs)
    names = quality_report(whole, "k", "year", ["v", "w"], ["v"]).columns
    assert (rows(merged.select(names)), rows(merged_coverage(partials, ["v", "w"]))) == wanted


def test_merged_as_whole(store, frame, monkeypatch):
    made, real = [], summaries.partial_report
    monkeypatch.setattr(summaries, "partial_report", lambda df, *a: made.append(rows(df.select("year").distinct(), "year")) or real(df, *a))
    store.upsert(frame(ROWS, *data(2000, 2006), ("n", 1, 1.0, None)), "gold", "t", mode="replace")
    both(store)
    both(store)
    store.upsert(frame(ROWS, *data(2004, 2008, 2)), "gold", "t", mode="replace")
    both(store)
    store.overwrite(frame(ROWS, *data(2001, 2003)), "gold", "t", ["year"])
    both(store)
    years = lambda *found: [(y,) for y in found]
    assert made == [years(None, *range(2000, 2006)), years(*range(2004, 2008)), years(2001, 2002)]


def test_a_slice_that_goes_leaves_the_report(store, frame):
    store.overwrite(frame("k STRING, v INT, w DOUBLE, year INT", *data(2000, 2003)), "gold", "t", ["year"])
    both(store)
    store.replace_slice(store.read("gold", "t").limit(0), "gold", "t", "year", 2001)
    both(store)
    assert rows(refresh_partials(store, "gold", "t", **OPTIONS)[0].select("year"), "year") == [(2000,), (2002,)]


def test_estimate_of_distinct_entities(spark):
    df = spark.range(40_000).select((F.col("id") % 9000).alias("k"), (F.col("id") % 7).alias("year"), F.lit(1).alias("v"))
    estimate = merged_quality(partial_report(df, "year", ["v"], "k", "year"), ["v"]).first()
    assert abs(estimate.distinct_entities / 9000 - 1) < 0.03 and estimate.total_rows == 40_000
    empty = merged_quality(partial_report(df.limit(0), "year", ["v"], "k", "year"), ["v"]).first()
    assert (empty.total_rows, empty.distinct_entities, empty.period_min) == (0, 0, None)


def test_tables_without_partitions_are_refused(store, frame):
    store.overwrite(frame(ROWS, *data(2000, 2001)), "gold", "t")
    with pytest.raises(ValueError, match="partitioned"):
        refresh_partials(store, "gold", "t", **OPTIONS)
