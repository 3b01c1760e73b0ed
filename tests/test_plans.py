"""What the plans must look like to hold at scale."""

from datetime import datetime

from pyspark.sql import functions as F

from panelkit import operators as op
from panelkit.plans.silver import refine
from panelkit.sources import FEEDS, parse_json_records, read_since
from panelkit.sources.tables import _rebalanced
from parity import views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_by_prunes_before_the_shuffle(spark, frame):
    df = frame("k INT, at TIMESTAMP, v INT", (1, datetime(2024, 1, 1), 1)).repartition(2)
    text = plan(op.latest_by(df, ["k"], "at"))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("hashpartitioning(k") < text.index("Partial")


def test_since_reaches_the_scan(spark, tmp_path, frame):
    path = str(tmp_path / "t")
    frame("v INT, w INT, ingested_at TIMESTAMP", (1, 2, datetime(2024, 1, 1))).write.parquet(path)
    text = plan(read_since(spark.read.parquet(path)).select("v"))
    assert "GreaterThanOrEqual(ingested_at" in text
    assert "ReadSchema: struct<v:int,ingested_at:timestamp>" in text


def test_outer_panel_shuffles_once(spark, frame):
    sources = [frame(f"k INT, y INT, v{i} INT", (1, 2, 3)) for i in range(6)]
    text = plan(op.outer_panel(sources, ["k", "y"]))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_series_operators_share_one_shuffle_and_sort(spark, frame):
    df = frame("k INT, year INT, v BIGINT", (1, 2000, 3))
    grown = op.yoy_growth(df, ["k"], "year", "v")
    text = plan(op.naive_projection(grown, ["k"], "year", "v"))
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1


def test_sums_with_labels_hash_before_they_sort(spark, frame):
    df = frame("k INT, label STRING, v INT", (1, "a", 3))
    text = plan(op.sum_with_labels(df, ["k"], {"v": F.sum("v")}, ["label"]))
    # nearest to the scan comes a hash aggregation
    assert text.rindex("HashAggregate") > text.rindex("SortAggregate")


def test_grid_is_built_without_a_join_of_all_pairs(spark, frame):
    text = plan(op.densify(frame("k INT, y INT, v INT", (1, 2000, 1)), "k", "y", {"v": 0}))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Subquery" in text


def test_score_needs_no_window(spark, frame):
    text = plan(op.minmax_score(frame("k INT, y INT, v INT", (1, 2000, 1)), "y", {"s": "v"}))
    assert "Window" not in text


def test_prorata_makes_a_row_per_year_not_per_day(spark, frame):
    df = frame("s STRING, e STRING, a DOUBLE", ("2000-01-01", "2009-12-31", 1.0))
    assert op.prorate_by_year(df, "s", "e", {"x": "a"}).count() == 10


def test_refine_is_one_stage_of_shuffle(spark, frame):
    feed = FEEDS["conflict_events"]
    df = spark.createDataFrame([], feed.ddl + ", ingested_at TIMESTAMP").repartition(2)
    assert plan(refine(df, feed)).count("hashpartitioning") == 1


def test_place_reports_read_only_what_they_need(spark):
    text = plan(views.place_reports(spark, "/root/testdata/sf0.001"))
    assert "l_extendedprice" not in text and "l_orderkey" not in text


def test_composed_queries_read_lines_and_orders_at_most_twice(spark):
    from parity import QUERIES

    for name in ("country_fact", "host_pressure_indices", "aid_demand", "aid_risk_profile"):
        text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        for table in ("lineitem", "orders"):
            assert text.count(f"/{table}.parquet") <= 2, (name, table)


def test_json_is_parsed_once_per_record(spark, frame):
    feed = FEEDS["population"]
    parsed = parse_json_records(frame("value STRING", ("{}",)), feed.schema, feed.mapping)
    assert plan(parsed).count("from_json(") == 1


def test_partitioned_writes_gather_and_split_partitions(spark, frame):
    df = frame("year INT, v INT", (2000, 1))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(_rebalanced(df, ["year"]))
