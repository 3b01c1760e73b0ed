import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.sources import (
    FEEDS,
    parse_json_records,
    read_since,
    stamp_ingested,
    typed_fields,
    unreadable_pages,
    unwrap_records,
)
from panelkit.streaming import ingest_feed
from tests.conftest import rows

DDL = "id INT, code STRING, who STRUCT<name: STRING, n: INT>, v DOUBLE, ok BOOLEAN"
FIELDS = {"id": "id", "code": "code", "who.name": "name", "who.n": "n", "v": "v", "ok": "ok"}


def parse(frame, *texts, **options):
    df = frame("value STRING", *[(t,) for t in texts])
    return rows(parse_json_records(df, StructType.fromDDL(DDL), FIELDS, **options), F.col("id").asc_nulls_last())


def test_values_that_do_not_fit_become_null_alone(frame):
    found = parse(
        frame,
        '{"id": "12", "code": "007", "who": {"name": "O\'Neil", "n": "-"}, "v": "1.5", "ok": "true"}',
        '{"id": 13, "code": 8, "who": {"name": null, "n": 4.5}, "v": 2, "ok": false, "more": []}',
        '{"id": 14}',
    )
    assert found == [
        (12, "007", "O'Neil", None, 1.5, True), (13, "8", None, None, 2.0, False), (14, None, None, None, None, None),
    ]


def test_compat_rewrites_the_text(frame):
    found = parse(frame, '{"id": "12", "code": "7", "who": {"name": "O\'Neil"}}', '{"id": 1, "code": "007"}', compat=True)
    assert found == [(12, "7", "O*Neil", None, None, None), (None,) * 6]


def test_broken_records_can_be_set_aside(frame):
    found = parse(frame, '{"id": 1, "code": "a"', "", '{"id": 2}', raw_out="raw")
    assert [(r[0], r[-1]) for r in found] == [(2, None), (None, '{"id": 1, "code": "a"'), (None, "")]


def test_binary_messages(frame):
    df = frame("value STRING", ('{"id": 5}',)).select(F.col("value").cast("binary").alias("value"))
    assert rows(parse_json_records(df, StructType.fromDDL(DDL), {"id": "id"})) == [(5,)]


PAGES = {
    "list": [{"page": 1}, [{"a": 1}, {"a": 2}], [{"a": 99}]],
    "list without records": [{"page": 1}, 2],
    "items": {"items": [{"a": 3}], "data": [{"a": 99}]},
    "results": {"x": [{"a": 99}], "results": [{"a": 4}, {"a": 5}]},
    "empty items": {"items": [], "rows": [{"a": 99}]},
    "first list of objects": {"z": [], "y": [1], "rows": [{"a": 6}], "a": [{"a": 99}]},
    "items is no list": {"items": {"a": 1}, "data": [{"a": 7}]},
    "nothing": {"count": 0, "rows": []},
}


def test_unwrap_pages(frame):
    df = frame("name STRING, body STRING", *[(k, json.dumps(v)) for k, v in PAGES.items()], ("broken", "[1,"))
    unwrapped = unwrap_records(df, "body", keep=["name"])
    found = [(name, json.loads(value)["a"]) for name, value in rows(unwrapped, "name", "value")]
    assert found == [
        ("first list of objects", 6), ("items", 3), ("items is no list", 7), ("list", 1), ("list", 2),
        ("results", 4), ("results", 5),
    ]
    assert rows(unreadable_pages(df, "body").select("name"), "name") == [("broken",), ("nothing",)]


def test_read_since(spark, frame):
    df = frame("v INT, ingested_at TIMESTAMP", (1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)))
    assert rows(read_since(df, since="2024-01-02").select("v")) == [(2,)]
    assert rows(read_since(stamp_ingested(df.drop("ingested_at"))).select("v"), "v") == [(1,), (2,)]
    assert read_since(df).count() == 0


def test_registry_is_consistent():
    assert len(FEEDS) == 16 and len({f.table for f in FEEDS.values()}) == 16
    for feed in FEEDS.values():
        columns = set(feed.mapping.values())
        assert {*feed.not_null, *feed.keys, *feed.placeholder_ints} <= columns
        if feed.year_rule in ("period_start", "period_span"):
            assert {"reference_period_start", "reference_period_end"} <= columns
        else:
            assert ("year" in columns) == (feed.year_rule == "native")


def write_messages(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))


def test_stream_appends_only_what_is_new(store, tmp_path):
    feed, inbox = FEEDS["worldbank_gdp"], tmp_path / "inbox"

    def record(code, year, value):
        return {"countryiso3code": code, "country": {"id": "x", "value": code.lower()}, "date": str(year), "value": value}

    write_messages(inbox, "1.json", record("AFG", 2020, 1.5), record("BEN", 2021, None))
    ingest_feed(store, feed, "text", {"path": str(inbox)})
    bronze = ["location_code", "location_name", "year", "gdp_per_capita"]
    first = rows(store.read("bronze", feed.table).select(*bronze), "location_code")
    assert first == [("AFG", "afg", 2020, 1.5), ("BEN", "ben", 2021, None)]
    ingest_feed(store, feed, "text", {"path": str(inbox)})
    assert store.read("bronze", feed.table).count() == 2
    write_messages(inbox, "2.json", record("AFG", 2020, 2.5))
    ingest_feed(store, feed, "text", {"path": str(inbox)})
    assert store.read("bronze", feed.table).count() == 3
    assert store.read("bronze", feed.table).filter("ingested_at IS NULL").count() == 0


def test_unknown_fields_are_kept_and_read_later(frame):
    schema = StructType.fromDDL("id INT, place STRUCT<code: STRING>")
    texts = [
        '{"id": 1, "place": {"code": "a"}}', '{"id": "2", "place": {"code": "b", "level": 3}, "note": "x", "n": "7"}',
        '{"note": null, "n": 1.5, "list": [1, {"a": 2}]}', '[1, 2]', '"text"', "{broken", None, "",
    ]
    found = parse_json_records(
        frame("value STRING", *[(t,) for t in texts]), schema, {"id": "id", "place.code": "code"}, raw_out="bad", rest_out="rest"
    )
    seen = [(r.id, r.code, r.bad, r.rest) for r in found.select("id", "code", "bad", F.to_json("rest").alias("rest")).collect()]
    assert seen == [
        (1, "a", None, None), (2, "b", None, '{"n":"7","note":"x","place":{"code":"b","level":3}}'),
        (None, None, None, '{"list":[1,{"a":2}],"n":1.5,"note":null}'), (None, None, None, None), (None, None, None, None),
        (None, None, "{broken", None), (None, None, None, None), (None, None, "", None),
    ]
    grown = StructType.fromDDL("id INT, place STRUCT<code: STRING, level: INT>, note STRING, n INT, list STRING")
    fields = {"id": "id", "place.code": "code", "place.level": "level", "note": "note", "n": "n", "list": "list"}
    late = typed_fields(found, grown, fields, "rest").select(*fields.values())
    assert [tuple(r) for r in late.collect()][:3] == [
        (1, "a", None, None, None, None), (2, "b", 3, "x", 7, None), (None, None, None, None, None, '[1,{"a":2}]'),
    ]


def test_records_with_all_kept_are_parsed_once(frame):
    feed = FEEDS["population"]
    parsed = parse_json_records(frame("value STRING", ("{}",)), feed.schema, feed.mapping, raw_out="bad", rest_out="rest")
    text = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("parse_json(") + text.count("parseJson") == 1 and "from_json(" not in text
