"""Published versions: what readers and other writers see, and what is left when a writer dies."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelkit.sources import batches, versions
from panelkit.sources.storage import create_text, names_in, read_text
from panelkit.sources.versions import ConcurrentWrite
from panelkit.streaming.ingest import write_batch
from tests.conftest import rows

ROWS = "k STRING, v INT, ingested_at TIMESTAMP, year INT"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
KEYS = {"keys": ["k", "year"]}


def table(store):
    return rows(store.read("silver", "t").select("k", "v", "year"), "year", "k")


def folders(store):
    return [n for n in names_in(store.spark, store.path("silver", "t")) if n.startswith("_commit=")]


@pytest.fixture
def filled(store, frame):
    store.upsert(frame(ROWS, ("a", 1, T1, 2020), ("a", 2, T1, 2021), ("n", 3, T1, None)), "silver", "t", **KEYS)
    return store


def test_one_writer_makes_a_file(spark, tmp_path):
    path = str(tmp_path / "folder" / "000000000001")
    assert create_text(spark, path, "first") and not create_text(spark, path, "second")
    assert read_text(spark, path) == "first" and names_in(spark, str(tmp_path / "folder")) == ["000000000001"]


def test_writers_in_other_years_do_not_repeat_their_work(filled, frame, monkeypatch):
    writes, write = [], versions.write_folder
    monkeypatch.setattr(versions, "write_folder", lambda *a: writes.append(1) or write(*a))
    other = lambda: filled.upsert(frame(ROWS, ("x", 5, T2, 2021)), "silver", "t", **KEYS)
    filled.upsert(frame(ROWS, ("y", 6, T2, 2020), ("z", 7, T2, 2022)), "silver", "t", meanwhile=other, **KEYS)
    assert len(writes) == 2 and filled.version("silver", "t").number == 3
    assert table(filled) == [("n", 3, None), ("a", 1, 2020), ("y", 6, 2020), ("a", 2, 2021), ("x", 5, 2021), ("z", 7, 2022)]


def test_writers_in_the_same_year_merge_again(filled, frame):
    others = iter([frame(ROWS, ("x", 5, T2, 2020), ("y", 1, T1, 2020))])

    def other():
        for batch in others:
            filled.upsert(batch, "silver", "t", **KEYS)

    filled.upsert(frame(ROWS, ("y", 6, T2, 2020)), "silver", "t", meanwhile=other, **KEYS)
    assert table(filled) == [("n", 3, None), ("a", 1, 2020), ("x", 5, 2020), ("y", 6, 2020), ("a", 2, 2021)]
    # what the first try wrote is gone, the versions before stay as they were
    assert len(folders(filled)) == 3


def test_writers_at_the_same_time(store, frame):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: store.upsert(frame(ROWS, (f"k{i}", i, T1, 2020)), "silver", "t", **KEYS), range(6)))
    assert table(store) == [(f"k{i}", i, 2020) for i in range(6)]
    assert store.version("silver", "t").number == 6


def test_a_writer_that_never_wins_gives_up(filled, frame, monkeypatch):
    monkeypatch.setattr(versions, "ATTEMPTS", 2)
    count = iter(range(100))
    other = lambda: versions.commit(filled.spark, filled.path("silver", "t"), lambda base: versions.Change(
        versions.write_folder(batch := frame(ROWS, ("x", next(count), T2, 2020)), filled.path("silver", "t"), ["year"])[0],
        batch.schema, ("year",), frozenset({"year=2020"}), ("year=2020",),
    ))
    with pytest.raises(ConcurrentWrite):
        filled.upsert(frame(ROWS, ("y", 6, T2, 2020)), "silver", "t", meanwhile=other, **KEYS)
    assert ("x", 1, 2020) in table(filled)


def test_a_slice_that_another_writer_changed_is_an_error(store, frame):
    schema = "k STRING, v INT, is_forecast BOOLEAN"
    store.overwrite(frame(schema, ("a", 1, False), ("a", 2, True)), "gold", "t", ["is_forecast"])
    own = store.read("gold", "t").filter("is_forecast").withColumn("v", F.col("v") + 1)
    real = versions.write_folder

    def slow(df, path, by):
        found = real(df, path, by)
        if pending:
            store.replace_slice(frame(schema, ("b", pending.pop(), True)), "gold", "t", "is_forecast", True)
        return found

    pending = [9]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(versions, "write_folder", slow)
        with pytest.raises(ConcurrentWrite):
            store.replace_slice(own, "gold", "t", "is_forecast", True)
    assert rows(store.read("gold", "t"), "v") == [("a", 1, False), ("b", 9, True)]


def test_readers_keep_their_version_until_the_next_but_one(filled, frame):
    reader, number = filled.read("silver", "t").select("k", "v", "year"), filled.version("silver", "t").number
    before = rows(reader, "year", "k")
    filled.upsert(frame(ROWS, ("a", 9, T2, 2020)), "silver", "t", **KEYS)
    assert rows(reader, "year", "k") == before and table(filled) != before
    assert rows(filled.read("silver", "t", version=number).select("k", "v", "year"), "year", "k") == before
    filled.upsert(frame(ROWS, ("a", 10, T2, 2020)), "silver", "t", **KEYS)
    # the partitions that nobody touched are still where they were first written
    assert len({f.partition("/")[0] for f in filled.version("silver", "t").folders}) == 2


def test_a_killed_writer_leaves_a_folder_that_vacuum_deletes(filled, frame):
    def kill():
        raise KeyboardInterrupt

    before, kept = table(filled), folders(filled)
    with pytest.raises(KeyboardInterrupt):
        filled.upsert(frame(ROWS, ("a", 9, T2, 2020)), "silver", "t", meanwhile=kill, **KEYS)
    assert table(filled) == before and len(folders(filled)) == len(kept) + 1
    path = filled.path("silver", "t")
    assert versions.vacuum(filled.spark, path) == []
    assert len(versions.vacuum(filled.spark, path, hours=0)) == 1 and folders(filled) == kept and table(filled) == before


def test_marks_move_with_the_rows(filled, frame):
    path = filled.path("silver", "t")
    filled.upsert(frame(ROWS, ("b", 1, T2, 2020)), "silver", "t", marks={"bronze": {"s": 3, "r": 1}}, **KEYS)
    filled.upsert(frame(ROWS), "silver", "t", marks={"bronze": {"s": 2, "r": 5}}, **KEYS)
    at = filled.version("silver", "t")
    assert at.marks == {"bronze": {"s": 3, "r": 5}} and len(table(filled)) == 4
    filled.upsert(frame(ROWS), "silver", "t", **KEYS)
    assert filled.version("silver", "t") == at
    assert versions.mark(filled.spark, path, {"bronze": {"s": 4}}).marks == {"bronze": {"s": 4, "r": 5}}
    assert table(filled) == rows(filled.read("silver", "t", version=at.number).select("k", "v", "year"), "year", "k")


def test_partitions_with_odd_names(store, frame):
    schema = "source STRING, day INT, v INT"
    values = ["a.b", "it's", "x=y/z", "ü %", None, "back\\slash"]
    store.overwrite(frame(schema, *[(s, i, i) for i, s in enumerate(values)]), "silver", "odd", ["source", "day"])
    assert rows(store.read("silver", "odd").select("source", "day"), "day") == [(s, i) for i, s in enumerate(values)]
    store.ensure_table("silver", "odd")
    assert rows(store.spark.sql("SELECT source, v FROM silver.odd"), "v") == [(s, i) for i, s in enumerate(values)]
    store.spark.sql("DROP DATABASE silver CASCADE")


def test_the_catalog_entry_follows_columns_and_partitions(store, spark, frame):
    store.overwrite(frame("k STRING, v INT", ("a", 1)), "gold", "t")
    store.ensure_table("gold", "t")
    store.overwrite(frame("k STRING, w STRING, year INT", ("a", "x", 2020), ("b", "y", None)), "gold", "t", ["year"])
    assert rows(spark.sql("SELECT * FROM gold.t")) == [("a", 1)]
    store.ensure_table("gold", "t")
    assert rows(spark.sql("SELECT * FROM gold.t"), "k") == [("a", "x", 2020), ("b", "y", None)]
    for v in range(3):
        store.upsert(frame("k STRING, w STRING, year INT", ("c", str(v), 2021)), "gold", "t", mode="replace")
        store.ensure_table("gold", "t")
    plan = spark.sql("SELECT * FROM gold.t WHERE year = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert len([t for t in spark.catalog.listTables("gold") if t.name.startswith("t__v")]) == 2
    spark.sql("DROP DATABASE gold CASCADE")


def test_batches(spark, frame, tmp_path):
    path, schema = str(tmp_path / "raw"), "v INT, ingested_on STRING"
    write_batch(frame(schema, (1, "d1")), path, "s1", 0, ["ingested_on"])
    write_batch(frame(schema, (2, "d1"), (3, "d2")), path, "s1", 1, ["ingested_on"])
    write_batch(frame(schema, (9, "d9")), path, "s1", 1, ["ingested_on"])  # again: nothing happens
    write_batch(frame(schema, (4, "d2")), path, "s2", 0, ["ingested_on"])
    assert rows(batches.read(spark, path).select("v"), "v") == [(1,), (2,), (3,), (4,)]
    found = batches.names(spark, path)
    assert batches.marks_of(found) == {"s1": 1, "s2": 0}
    new = batches.unread(found, {"s1": 0})
    assert rows(batches.read(spark, path, chosen=new).select("v"), "v") == [(2,), (3,), (4,)]
    (tmp_path / "raw" / "_batch=s1-000000000001" / "_SUCCESS").unlink()
    assert rows(batches.read(spark, path).select("v"), "v") == [(1,), (4,)]
    write_batch(frame(schema, (5, "d3")), path, "s1", 1, ["ingested_on"])
    assert rows(batches.read(spark, path).select("v"), "v") == [(1,), (4,), (5,)]
    plan = batches.read(spark, path).filter("ingested_on = 'd3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingested_on" in plan and "MetadataLogFileIndex" not in plan


def test_a_local_folder_is_no_shared_one(spark, monkeypatch):
    from types import SimpleNamespace

    from panelkit.sources.tables import checkpoint_dir

    bare = SimpleNamespace(sparkContext=SimpleNamespace(
        getCheckpointDir=lambda: None, getConf=lambda: SimpleNamespace(get=lambda key: None), master="yarn",
    ))
    with pytest.raises(RuntimeError, match="checkpoint"):
        checkpoint_dir(bare)
