"""Ingestion, cleaning and sinks over the driver tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.operators import (
    conform,
    date_parts,
    explode_years,
    latest_by,
    latest_value,
    null_if_cast,
    one_per_key,
    require_not_null,
    unparsed_periods,
)
from panelkit.sources import (
    TableStore,
    between_years,
    checkpoint_dir,
    parse_json_records,
    read_since,
    stamp_ingested,
    unreadable_pages,
    unwrap_records,
)
from panelkit.streaming import append_stream, read_stream
from parity.registry import query
from parity.views import customer_year, funding, iso, nation_year, table, with_ctes

EVENT_DDL = "id BIGINT, who STRUCT<user: BIGINT>, kind STRING, amount DOUBLE"
EVENT_FIELDS = {"id": "event_id", "who.user": "user_id", "kind": "event_type", "amount": "value"}
EVENT_SQL = "SELECT event_id, user_id, event_type, value FROM events"


def _event_json():
    """An event as a feed would send it: numbers quoted, the user nested."""
    return F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), F.struct(F.col("user_id").alias("user")).alias("who"),
        F.col("event_type").alias("kind"), F.col("value").alias("amount"),
    ))


def _scratch(spark: SparkSession) -> TableStore:
    return TableStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/tables-{uuid4().hex}")


@query(sql="SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    # The id travels inside the record, as a feed's key would.
    text = F.concat(F.lit('{"id": "'), F.col("event_id"), F.lit('", "props": '), F.col("props"), F.lit("}"))
    schema = StructType.fromDDL("id BIGINT, props STRUCT<k: INT>")
    return parse_json_records(events.select(text.alias("value")), schema, {"id": "event_id", "props.k": "k"})


@query(sql="""
    SELECT doc_id, replace(text, '''', '*') AS text, replace(source, '''', '*') AS source, n_chars
    FROM documents""")
def json_compat(spark: SparkSession, d: str) -> DataFrame:
    """Whole documents through the older rewriting: apostrophes become asterisks, numbers lose quotes."""
    record = F.struct(
        F.col("doc_id").cast("string").alias("id"), "text", "source", F.col("n_chars").cast("string").alias("n")
    )
    messages = table(spark, d, "documents").select(F.to_json(record).alias("value"))
    schema = StructType.fromDDL("id BIGINT, text STRING, source STRING, n BIGINT")
    fields = {"id": "doc_id", "text": "text", "source": "source", "n": "n_chars"}
    return parse_json_records(messages, schema, fields, compat=True)


@query(sql=EVENT_SQL)
def unwrap_pages(spark: SparkSession, d: str) -> DataFrame:
    """Events packed into API pages of at most 50, in the four shapes of answer, and unpacked."""
    events = table(spark, d, "events").select(
        F.floor(F.col("event_id") / 50).alias("page"), F.parse_json(_event_json()).alias("record")
    )
    pages = events.groupBy("page").agg(F.to_json(F.collect_list("record")).alias("records"))
    heads = F.array(*[F.lit(h) for h in (
        '{"meta": 1, "items": ', '{"results": ', '{"page": {"n": 3}, "data": ', '[{"page": 1}, ', '{"odd": [], "rows": ',
    )])
    head = F.element_at(heads, (F.col("page") % 5 + 1).cast("int"))
    tail = F.when(head.startswith("["), "]").otherwise("}")
    answers = pages.select(F.concat(head, F.col("records"), tail).alias("body"))
    return parse_json_records(unwrap_records(answers, "body"), StructType.fromDDL(EVENT_DDL), EVENT_FIELDS)


@query(sql=EVENT_SQL)
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream of JSON messages, parsed, stamped, appended and read back."""
    # A pattern rather than the path itself, since the streaming source lists folders.
    source = read_stream(
        spark, "parquet", {"path": f"{d}/events.parque[t]"}, table(spark, d, "events").schema
    )
    messages = source.select(_event_json().cast("binary").alias("value"))
    rows = stamp_ingested(parse_json_records(messages, StructType.fromDDL(EVENT_DDL), EVENT_FIELDS))
    store = _scratch(spark)
    append_stream(rows, store.path("bronze", "events"), f"{store.root}/checkpoint").awaitTermination()
    return store.read("bronze", "events").drop("ingested_at", "ingested_on")


@query(sql="SELECT event_id, user_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def incremental_since(spark: SparkSession, d: str) -> DataFrame:
    """Events appended to a raw table as if they had come at their time, and those of its later days read."""
    events = table(spark, d, "events")
    source = read_stream(spark, "parquet", {"path": f"{d}/events.parque[t]"}, events.schema)
    stamped = source.select("event_id", "user_id", "value", F.col("ts").cast("timestamp").alias("ingested_at"))
    store = _scratch(spark)
    append_stream(stamped, store.path("bronze", "events"), f"{store.root}/checkpoint").awaitTermination()
    return read_since(store.read("bronze", "events"), since="2024-01-15").select("event_id", "user_id", "value")


@query(sql="""
    SELECT event_id, CAST(NULL AS VARCHAR) AS bad_record FROM events WHERE event_id % 7 <> 0
    UNION ALL
    SELECT NULL, '{"id": "' || event_id || '", "who' FROM events WHERE event_id % 7 = 0""")
def bad_json(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh message is cut short: kept and set aside are together what was read."""
    broken = F.concat(F.lit('{"id": "'), F.col("event_id"), F.lit('", "who'))
    text = F.when(F.col("event_id") % 7 == 0, broken).otherwise(_event_json())
    messages = table(spark, d, "events").select(text.alias("value"))
    found = parse_json_records(messages, StructType.fromDDL(EVENT_DDL), EVENT_FIELDS, raw_out="bad_record")
    return found.select("event_id", "bad_record")


@query(sql=with_ctes("funding", body="SELECT o_orderkey, reference_period_end IS NULL AS is_unparsed FROM funding"))
def unparsed_appeals(spark: SparkSession, d: str) -> DataFrame:
    """Appeals that no year can be given to, and all others."""
    appeals = funding(spark, d).select("o_orderkey", "reference_period_start", "reference_period_end")
    period = ("reference_period_start", "reference_period_end")
    placed = explode_years(appeals, *period).select("o_orderkey").distinct().withColumn("is_unparsed", F.lit(False))
    return placed.unionByName(unparsed_periods(appeals, *period).select("o_orderkey", F.lit(True).alias("is_unparsed")))


@query(sql="SELECT event_id, event_id % 5 IN (3, 4) AS is_unreadable FROM events")
def unreadable_answers(spark: SparkSession, d: str) -> DataFrame:
    """API pages of one record each, some of them no JSON or without a list of records."""
    events = table(spark, d, "events").select("event_id", _event_json().alias("record"))
    kind = F.col("event_id") % 5
    body = (
        F.when(kind == 3, F.concat(F.lit('{"items": 5, "id": '), F.col("event_id"), F.lit("}")))
        .when(kind == 4, F.concat(F.lit("<html>"), F.col("event_id")))
        .otherwise(F.concat(F.lit('{"items": ['), F.col("record"), F.lit("]}")))
    )
    pages = events.select(body.alias("body"))
    read = parse_json_records(unwrap_records(pages, "body"), StructType.fromDDL(EVENT_DDL), EVENT_FIELDS)
    lost = unreadable_pages(pages, "body").select(
        F.regexp_extract("body", r"(\d+)}?$", 1).cast("bigint").alias("event_id")
    )
    return read.select(
        "event_id", F.lit(False).alias("is_unreadable")
    ).unionByName(lost.withColumn("is_unreadable", F.lit(True)))


@query(sql=with_ctes("nation_year", body="""
    SELECT location_code, year, amount_cents, n_orders FROM nation_year WHERE year BETWEEN 1996 AND 1999"""))
def year_range(spark: SparkSession, d: str) -> DataFrame:
    return between_years(nation_year(spark, d), 1996, 1999)


@query(sql="""
    SELECT event_id, event_type AS kind, user_id FROM events WHERE nullif(event_type, 'error') IS NOT NULL""")
def not_null(spark: SparkSession, d: str) -> DataFrame:
    kinds = table(spark, d, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("kind"), "user_id"
    )
    return require_not_null(kinds, ["kind", "user_id"])


@query(sql="""
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                            THEN CAST(left(o_orderpriority, 1) AS INT) END AS urgency
    FROM orders""")
def placeholder_cast(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "-").otherwise(F.left("o_orderpriority", F.lit(1)))
    return null_if_cast(
        table(spark, d, "orders").select("o_orderkey", raw.alias("urgency")), ["urgency"], "int"
    )


@query(sql="""
    SELECT event_id, user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS version
      FROM events) WHERE version = 1""")
def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    return latest_by(table(spark, d, "events"), ["user_id", "event_type"], "ts", ["event_id"]).select(
        "event_id", "user_id", "event_type", "value"
    )


@query(sql="""
    SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year,
           arg_max_null(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice,
           arg_max_null(nullif(o_orderstatus, 'P'), (o_orderdate, o_orderkey)) AS settled
    FROM orders GROUP BY 1, 2""")
def max_by_latest(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), "o_orderdate", "o_orderkey", "o_totalprice",
        F.nullif("o_orderstatus", F.lit("P")).alias("settled"),
    )
    return latest_value(
        orders, ["o_custkey", "year"], ["o_totalprice", "settled"], "o_orderdate", ["o_orderkey"]
    )


@query(name="one_per_key", sql="""
    SELECT o_custkey, o_orderkey, o_orderpriority FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rank
      FROM orders) WHERE rank = 1""")
def first_order_per_customer(spark: SparkSession, d: str) -> DataFrame:
    return one_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderpriority"
    )


@query(name="date_parts", sql="""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
           CAST(day(o_orderdate) AS INT) AS day
    FROM orders""")
def iso_date_parts(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "orders").select("o_orderkey", iso("o_orderdate").alias("placed"))
    return date_parts(texts, "placed").drop("placed")


@query(name="explode_years", sql=with_ctes("funding", body="""
    SELECT o_orderkey, CAST(unnest(generate_series(
             least(year(reference_period_start), year(reference_period_end)),
             greatest(year(reference_period_start), year(reference_period_end)))) AS INT) AS year
    FROM funding WHERE reference_period_end IS NOT NULL"""))
def period_years(spark: SparkSession, d: str) -> DataFrame:
    """One row per year an appeal touches; a reversed period touches the same years."""
    return explode_years(
        funding(spark, d).select("o_orderkey", "reference_period_start", "reference_period_end"),
        "reference_period_start", "reference_period_end",
    ).select("o_orderkey", "year")


@query(sql=with_ctes("customer_year", body="""
    SELECT o_custkey, year, amount_cents, n_orders, false AS is_forecast FROM customer_year
    UNION ALL
    SELECT o_custkey, CAST(max(year) + 1 AS INT), NULL, NULL, true FROM customer_year GROUP BY o_custkey"""))
def conform_union(spark: SparkSession, d: str) -> DataFrame:
    """A row for the year after each customer's last, in the schema of the history."""
    history = customer_year(spark, d).withColumn("is_forecast", F.lit(False))
    last = history.groupBy("o_custkey").agg(F.max("year").alias("last"))
    ahead = conform(last, history.schema, {
        "o_custkey": F.col("o_custkey"), "year": F.col("last") + 1, "is_forecast": F.lit(True),
    })
    return history.unionByName(ahead)


@query(sql="""
    SELECT o_custkey, o_orderkey, year, o_totalprice FROM (
      SELECT *, CAST(year(o_orderdate) AS INT) AS year,
             CASE WHEN o_orderpriority = '1-URGENT' THEN year(o_orderdate) END AS urgent
      FROM orders)
    WHERE year NOT IN (SELECT urgent FROM (SELECT year(o_orderdate) AS urgent FROM orders
                       WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01'))
       OR urgent IS NOT NULL""")
def partition_upsert(spark: SparkSession, d: str) -> DataFrame:
    """All orders by year, then the urgent ones from 2000 on written over the years they touch."""
    orders = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    store = _scratch(spark)
    store.upsert(orders, "silver", "orders", mode="replace")
    urgent = orders.filter("o_orderpriority = '1-URGENT' AND o_orderdate >= DATE'2000-01-01'")
    store.upsert(urgent, "silver", "orders", mode="replace")
    return store.read("silver", "orders").select("o_custkey", "o_orderkey", "year", "o_totalprice")


@query(sql="""
    SELECT user_id, event_type, CAST(day AS INT) AS day, event_id, value FROM (
      SELECT *, dayofmonth(ts) AS day,
             row_number() OVER (PARTITION BY user_id, event_type, dayofmonth(ts) ORDER BY ts DESC, event_id DESC) AS v
      FROM events) WHERE v = 1""")
def partition_merge(spark: SparkSession, d: str) -> DataFrame:
    """The first half of the month, then the second half and late corrections merged in by key."""
    events = table(spark, d, "events").withColumn("day", F.dayofmonth("ts"))
    newest = latest_by(events, ["user_id", "event_type", "day"], "ts", ["event_id"])
    store = _scratch(spark)
    store.upsert(events.filter("day <= 20"), "silver", "events", partition="day", mode="replace")
    store.upsert(
        newest.filter("day > 10"), "silver", "events", partition="day", mode="merge",
        keys=["user_id", "event_type", "day"], order="ts",
    )
    merged = store.read("silver", "events")
    # The first ten days were written unmerged; the same operator settles them on reading.
    return latest_by(merged, ["user_id", "event_type", "day"], "ts", ["event_id"]).select(
        "user_id", "event_type", "day", "event_id", "value"
    )


@query(sql=with_ctes("customer_year", body="""
    SELECT o_custkey, year, n_orders, false AS is_forecast FROM customer_year
    UNION ALL
    SELECT o_custkey, CAST(max(year) + 1 AS INT), count(*), true FROM customer_year GROUP BY o_custkey"""))
def forecast_slice(spark: SparkSession, d: str) -> DataFrame:
    """Forecast rows written next to the history twice; the second run replaces the first."""
    history = customer_year(spark, d).select("o_custkey", "year", "n_orders", F.lit(False).alias("is_forecast"))
    store = _scratch(spark)
    store.overwrite(history, "gold", "orders", ["is_forecast"])
    written = store.read("gold", "orders", is_forecast="boolean").filter("NOT is_forecast")
    ahead = written.groupBy("o_custkey").agg(
        (F.max("year") + 1).alias("year"), F.count(F.lit(1)).alias("n_orders"), F.lit(True).alias("is_forecast")
    )
    store.replace_slice(ahead.withColumn("n_orders", F.col("n_orders") + 1), "gold", "orders", "is_forecast", True)
    store.replace_slice(ahead, "gold", "orders", "is_forecast", True)
    return store.read("gold", "orders", is_forecast="boolean")


@query(sql="""
    SELECT user_id, event_type, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS v FROM events)
    WHERE v = 1""")
def merge_into_new_table(spark: SparkSession, d: str) -> DataFrame:
    """Events merged by key where there is no table yet, then the last week again: one row per key."""
    # Ties of the time go to the larger id, as the order is one column.
    events = table(spark, d, "events").withColumn("version", F.struct("ts", "event_id"))
    store, by = _scratch(spark), {"keys": ["user_id", "event_type"], "order": "version"}
    store.upsert(events, "silver", "events", **by)
    store.upsert(events.filter("ts >= TIMESTAMP'2024-01-24'"), "silver", "events", **by)
    return store.read("silver", "events").select("user_id", "event_type", "event_id", "value")


@query(sql=with_ctes("customer_year", body="""
    SELECT o_custkey, year, n_orders, false AS is_forecast FROM customer_year
    UNION ALL
    SELECT o_custkey, CAST(year + 1 AS INT), n_orders + 2, true FROM customer_year"""))
def replace_slice_from_itself(spark: SparkSession, d: str) -> DataFrame:
    """A forecast slice revised twice, each time from what the slice held before."""
    history = customer_year(spark, d).select("o_custkey", "year", "n_orders", F.lit(False).alias("is_forecast"))
    ahead = history.withColumn("year", F.col("year") + 1).withColumn("is_forecast", F.lit(True))
    store = _scratch(spark)
    store.overwrite(history.unionByName(ahead), "gold", "orders", ["is_forecast"])
    for _ in range(2):
        own = store.read("gold", "orders", is_forecast="boolean").filter("is_forecast")
        store.replace_slice(own.withColumn("n_orders", F.col("n_orders") + 1), "gold", "orders", "is_forecast", True)
    return store.read("gold", "orders", is_forecast="boolean")


@query(sql=with_ctes("nation_year", body="SELECT location_code, year, n_orders + 1 AS n_orders FROM nation_year"))
def catalog_table(spark: SparkSession, d: str) -> DataFrame:
    """A partitioned table in the catalog that has been replaced once, read by its name."""
    store, layer = _scratch(spark), f"lake_{uuid4().hex}"
    yearly = nation_year(spark, d).select("location_code", "year", "n_orders")
    for added in (0, 1):
        store.overwrite(yearly.withColumn("n_orders", F.col("n_orders") + added), layer, "nation_year", ["year"])
        store.ensure_table(layer, "nation_year")
    return spark.table(f"{layer}.nation_year").select("location_code", "year", "n_orders")


@query(sql=with_ctes("nation_year", body="""
    SELECT location_code, max(amount_cents) AS best_cents, arg_max(year, (amount_cents, year)) AS best_year
    FROM nation_year GROUP BY location_code HAVING count(*) > 1"""))
def sql_surface(spark: SparkSession, d: str) -> DataFrame:
    """A table written, registered and queried with SQL."""
    store = _scratch(spark)
    store.overwrite(nation_year(spark, d), "gold", "nation_year")
    store.register_views("gold", ["nation_year"])
    return spark.sql("""
        SELECT location_code, max(amount_cents) AS best_cents,
               max_by(year, struct(amount_cents, year)) AS best_year
        FROM gold_nation_year GROUP BY location_code HAVING count(*) > 1""")
