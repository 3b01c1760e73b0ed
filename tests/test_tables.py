from datetime import datetime

import pytest
from pyspark.sql import functions as F

from panelkit.sources import between_years, checkpointed
from panelkit.sources.tables import checkpoint_dir
from tests.conftest import rows

ROWS = "k STRING, v INT, ingested_at TIMESTAMP, year INT"
T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def table(store, name="t"):
    return rows(store.read("silver", name).select("k", "v", "year"), "year", "k")


def test_replace_touches_only_the_years_of_the_batch(store, frame):
    store.upsert(frame(ROWS, ("a", 1, T1, 2020), ("b", 2, T1, 2020), ("a", 3, T1, 2021), ("n", 4, T1, None)), "silver", "t", mode="replace")
    store.upsert(frame(ROWS, ("a", 9, T2, 2020)), "silver", "t", mode="replace")
    assert table(store) == [("n", 4, None), ("a", 9, 2020), ("a", 3, 2021)]


def test_merge_keeps_older_keys_of_a_touched_year(store, frame):
    store.upsert(frame(ROWS, ("a", 1, T1, 2020), ("b", 2, T1, 2020), ("a", 3, T1, 2021), ("n", 4, T1, None)), "silver", "t", mode="replace")
    batch = frame(ROWS, ("a", 9, T2, 2020), ("c", 5, T2, 2022), ("n", 6, T2, None), ("m", 7, T2, None))
    store.upsert(batch, "silver", "t", mode="merge", keys=["k", "year"])
    expected = [("m", 7, None), ("n", 6, None), ("a", 9, 2020), ("b", 2, 2020), ("a", 3, 2021), ("c", 5, 2022)]
    assert table(store) == expected
    store.upsert(batch, "silver", "t", mode="merge", keys=["k", "year"])
    assert table(store) == expected


def test_empty_batch_changes_nothing(store, frame):
    for mode in ("replace", "merge"):
        store.upsert(frame(ROWS, ("a", 1, T1, 2020)), "silver", "t", mode=mode, keys=["k"])
        store.upsert(frame(ROWS), "silver", "t", mode=mode, keys=["k"])
    assert table(store) == [("a", 1, 2020)]


def test_tables_without_a_year_are_replaced(store, frame):
    store.upsert(frame("k STRING, v INT", ("a", 1), ("b", 2)), "silver", "t", mode="replace")
    store.upsert(frame("k STRING, v INT", ("c", 3)), "silver", "t", mode="replace")
    assert rows(store.read("silver", "t")) == [("c", 3)]


def test_columns_added_later_are_read(store, frame):
    store.upsert(frame("k STRING, year INT", ("a", 2020)), "silver", "t", mode="replace")
    store.upsert(frame("k STRING, extra DOUBLE, year INT", ("b", 1.0, 2021)), "silver", "t", mode="replace")
    assert rows(store.read("silver", "t").select("k", "extra", "year"), "k") == [("a", None, 2020), ("b", 1.0, 2021)]


def test_unknown_mode(store, frame):
    with pytest.raises(ValueError):
        store.upsert(frame(ROWS), "silver", "t", mode="append")


def test_overwrite_allows_a_new_schema_and_reading_itself(store, frame):
    store.overwrite(frame("k STRING, v INT", ("a", 1)), "gold", "t")
    grown = store.read("gold", "t").withColumn("w", F.col("v") + 1)
    store.overwrite(grown, "gold", "t")
    assert rows(store.read("gold", "t")) == [("a", 1, 2)]


def test_replacing_a_slice_is_idempotent(store, frame):
    schema = "k STRING, v INT, is_forecast BOOLEAN"
    store.overwrite(frame(schema, ("a", 1, False), ("a", 2, True)), "gold", "t", ["is_forecast"])
    history = store.read("gold", "t", is_forecast="boolean").filter("NOT is_forecast")
    new = history.select("k", (F.col("v") + 10).alias("v"), F.lit(True).alias("is_forecast"))
    for _ in range(2):
        store.replace_slice(new, "gold", "t", "is_forecast", True)
        found = rows(store.read("gold", "t", is_forecast="boolean"), "v")
        assert found == [("a", 1, False), ("a", 11, True)]
    store.replace_slice(new.limit(0), "gold", "t", "is_forecast", True)
    assert rows(store.read("gold", "t", is_forecast="boolean")) == [("a", 1, False)]


def test_merge_needs_keys(store, frame):
    with pytest.raises(ValueError, match="keys"):
        store.upsert(frame(ROWS, ("a", 1, T1, 2020)), "silver", "t")


def test_merge_into_a_new_table_deduplicates(store, frame):
    store.upsert(frame(ROWS, ("a", 1, T1, 2020), ("a", 2, T2, 2020), ("b", 3, T1, 2020)), "silver", "t", keys=["k"])
    assert table(store) == [("a", 2, 2020), ("b", 3, 2020)]


def test_one_late_row_removes_no_other(store, frame):
    store.upsert(frame(ROWS, *[(f"k{i}", i, T1, 2020) for i in range(100)]), "silver", "t", keys=["k", "year"])
    store.upsert(frame(ROWS, ("late", 1, T2, 2020)), "silver", "t", keys=["k", "year"])
    assert len(table(store)) == 101


def test_merge_without_a_partition_column(store, frame):
    flat = "k STRING, v INT, ingested_at TIMESTAMP"
    store.upsert(frame(flat, ("a", 1, T1), ("b", 2, T1)), "silver", "t", keys=["k"])
    store.upsert(frame(flat, ("b", 3, T2), ("c", 4, T2)), "silver", "t", keys=["k"])
    assert rows(store.read("silver", "t").select("k", "v"), "k") == [("a", 1), ("b", 3), ("c", 4)]


def test_merge_reads_only_the_touched_partitions(store, spark, frame):
    from panelkit.sources import tables

    store.upsert(frame(ROWS, *[("a", y, T1, y) for y in range(2000, 2010)], ("a", 1, T1, None)), "silver", "t", keys=["k", "year"])
    batch = checkpointed(frame(ROWS, ("b", 1, T2, 2003), ("b", 1, T2, 2005)))
    plan = tables._touched(store.read("silver", "t"), batch, "year")._jdf.queryExecution().executedPlan().toString()
    assert "year#" in plan and ">= 2003" in plan and "<= 2005" in plan and "dynamicpruning" in plan
    found = tables._touched(store.read("silver", "t"), batch.union(frame(ROWS, ("n", 1, T2, None))), "year")
    assert rows(found.select("year"), "year") == [(None,), (2003,), (2005,)]


def test_a_slice_may_come_from_itself_and_survives_a_failure(store, frame):
    schema = "k STRING, v INT, is_forecast BOOLEAN"
    store.overwrite(frame(schema, ("a", 1, False), ("a", 2, True)), "gold", "t", ["is_forecast"])
    own = store.read("gold", "t", is_forecast="boolean").filter("is_forecast")
    store.replace_slice(own.withColumn("v", F.col("v") * 10), "gold", "t", "is_forecast", True)
    assert rows(store.read("gold", "t", is_forecast="boolean"), "v") == [("a", 1, False), ("a", 20, True)]
    broken = own.withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        store.replace_slice(broken, "gold", "t", "is_forecast", True)
    with pytest.raises(Exception, match="no"):
        store.overwrite(broken, "gold", "t", ["is_forecast"])
    assert rows(store.read("gold", "t", is_forecast="boolean"), "v") == [("a", 1, False), ("a", 20, True)]


def test_versions_keep_the_one_before_for_its_readers(store, frame):
    store.overwrite(frame("v INT", (1,)), "gold", "t")
    reader = store.read("gold", "t")
    store.overwrite(frame("v INT", (2,)), "gold", "t")
    assert rows(reader) == [(1,)] and rows(store.read("gold", "t")) == [(2,)]
    store.overwrite(frame("v INT", (3,)), "gold", "t")
    assert rows(store.read("gold", "t")) == [(3,)]


def test_an_unreadable_table_is_an_error(store, tmp_path):
    broken = tmp_path / "lake" / "silver" / "t"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        store.exists("silver", "t")
    assert not store.exists("silver", "nothing")


def test_released_frames_leave_no_files(spark, frame, tmp_path):
    from panelkit.sources.tables import _files, release

    df = checkpointed(frame("k STRING", ("a",)))
    folder = df.inputFiles()[0].rpartition("/")[0]
    release(df)
    files, where = _files(spark, folder)
    assert not files.exists(where)


def test_between_years_prunes_partitions(store, frame):
    store.upsert(frame(ROWS, *[("a", y, T1, y) for y in range(2000, 2010)]), "silver", "t", mode="replace")
    clipped = between_years(store.read("silver", "t"), 2003, 2004)
    assert [r[-1] for r in rows(clipped, "year")] == [2003, 2004]
    plan = clipped._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_catalog_and_views(store, spark, frame):
    store.overwrite(frame("k STRING, v INT", ("a", 1)), "gold", "t")
    store.ensure_table("gold", "t")
    store.ensure_table("gold", "t")
    assert rows(spark.sql("SELECT * FROM gold.t")) == [("a", 1)]
    store.register_views("gold", ["t"])
    assert rows(spark.sql("SELECT sum(v) FROM gold_t")) == [(1,)]
    store.upsert(frame(ROWS, ("a", 1, T1, 2020), ("b", 2, T1, 2021)), "gold", "yearly", mode="replace")
    store.ensure_table("gold", "yearly")
    assert rows(spark.sql("SELECT k, year FROM gold.yearly"), "k") == [("a", 2020), ("b", 2021)]
    store.upsert(frame(ROWS, ("c", 3, T1, 2022)), "gold", "yearly", mode="replace")
    store.ensure_table("gold", "yearly")
    assert spark.table("gold.yearly").filter("year >= 2021").count() == 2
    spark.sql("DROP DATABASE gold CASCADE")


def test_checkpoint_cuts_the_plan_and_keeps_the_rows(spark, frame):
    df = frame("k STRING, v INT", ("a", 1), ("b", None)).groupBy("k").agg(F.sum("v").alias("v"))
    cut = checkpointed(df)
    assert cut.schema == df.schema and rows(cut, "k") == rows(df, "k")
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and checkpoint_dir(spark).rpartition("/")[2] in cut.inputFiles()[0]
