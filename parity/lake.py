"""Published versions, ledgers and batches of the table layer over the driver tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.partials import merged_quality
from panelkit.plans.incremental import refresh_facts
from panelkit.plans.silver import refine, refresh_silver
from panelkit.plans.summaries import refresh_partials
from panelkit.sources import FEEDS, FeedSpec, TableStore, checkpoint_dir, checkpointed
from panelkit.sources import recorded
from panelkit.sources.storage import delete_folder, names_in
from panelkit.streaming import append_stream, ingest_feed, read_stream
from parity import views
from parity.gold import _rounded as rounded
from parity.registry import ORACLES, query
from parity.views import table

#: The events as a feed: its messages are JSON, a number quoted as feeds do.
EVENTS = FeedSpec(
    topic="events", table="events", ddl="id BIGINT, user BIGINT, kind STRING, amount DOUBLE",
    mapping={"id": "event_id", "user": "user_id", "kind": "event_type", "amount": "value"},
    not_null=("event_id",), keys=("event_id",), year_rule="none",
)


def scratch(spark: SparkSession) -> TableStore:
    return TableStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/tables-{uuid4().hex}")


def send(events: DataFrame, inbox: str) -> None:
    """Events as lines of JSON in a new folder of an inbox."""
    record = F.struct(
        F.col("event_id").cast("string").alias("id"), F.col("user_id").alias("user"),
        F.col("event_type").alias("kind"), F.col("value").alias("amount"),
    )
    events.select(F.to_json(record).alias("value")).write.text(f"{inbox}/{uuid4().hex}")


class Killed(RuntimeError):
    """Stands for the end of a process between two steps."""


def kill() -> None:
    raise Killed


@query(sql="SELECT event_id, user_id, CAST(dayofmonth(ts) AS INT) AS day, value FROM events")
def concurrent_publish(spark: SparkSession, d: str) -> DataFrame:
    """Three writers: the second and third merge into the same days, each publishing while the other is between writing and
    publishing. Nobody's rows are lost."""
    events = table(spark, d, "events").select("event_id", "user_id", F.dayofmonth("ts").alias("day"), "value", "ts")
    part = lambda k: events.filter(F.col("event_id") % 3 == k)
    store, by = scratch(spark), {"partition": "day", "keys": ["event_id"], "order": "ts"}
    store.upsert(part(0), "silver", "events", **by)
    # The other writer comes in once only; the second try finds nobody in between.
    others = iter([part(2)])

    def meanwhile() -> None:
        for rows in others:
            store.upsert(rows, "silver", "events", **by)

    store.upsert(part(1), "silver", "events", meanwhile=meanwhile, **by)
    return store.read("silver", "events").drop("ts")


@query(sql="""
    WITH old AS (SELECT event_id, CAST(dayofmonth(ts) AS INT) AS day, value FROM events WHERE dayofmonth(ts) <= 20),
    new AS (SELECT event_id, CAST(dayofmonth(ts) AS INT) AS day, value + 1 AS value FROM events WHERE dayofmonth(ts) > 10)
    SELECT 'during' AS seen, * FROM old UNION ALL SELECT 'failed', * FROM old
    UNION ALL SELECT 'after', * FROM new UNION ALL SELECT 'after', * FROM old WHERE day <= 10""")
def snapshot_during_merge(spark: SparkSession, d: str) -> DataFrame:
    """A table as a reader has it that opened it before a merge, after a merge that failed before it was published, and
    after one that was."""
    events = table(spark, d, "events").select("event_id", F.dayofmonth("ts").alias("day"), "value", "ts")
    store, by = scratch(spark), {"partition": "day", "keys": ["event_id"], "order": "ts"}
    store.upsert(events.filter("day <= 20"), "silver", "events", **by)
    newer = events.filter("day > 10").withColumns({"value": F.col("value") + 1, "ts": F.col("ts") + F.expr("INTERVAL 1 DAY")})
    during = store.read("silver", "events")
    try:
        store.upsert(newer, "silver", "events", meanwhile=kill, **by)
    except Killed:
        failed = store.read("silver", "events")
    store.upsert(newer, "silver", "events", **by)
    seen = {"during": during, "failed": failed, "after": store.read("silver", "events")}
    tables = [t.select(F.lit(name).alias("seen"), "event_id", "day", "value") for name, t in seen.items()]
    return tables[0].union(tables[1]).union(tables[2])


@query(sql="SELECT event_id, user_id, event_type, value FROM events")
def resume_after_missed_day(spark: SparkSession, d: str) -> DataFrame:
    """Events that come in four days. The second day has no refresh, that of the third is killed between writing and
    publishing; the next one takes in what was missed, and only that."""
    events = table(spark, d, "events")
    store = scratch(spark)
    inbox, counts = f"{store.root}/inbox", []
    for day in range(4):
        send(events.filter(F.floor(F.dayofyear("ts") / 8) % 4 == day), inbox)
        ingest_feed(store, EVENTS, "text", {"path": f"{inbox}/*"})
        if day == 2:
            try:
                refresh_silver(store, EVENTS, meanwhile=kill)
            except Killed:
                counts.append(store.version("silver", "events").number)
        elif day != 1:
            refresh_silver(store, EVENTS)
            counts.append(store.version("silver", "events").number)
    refresh_silver(store, EVENTS)  # nothing is new
    if [*counts, store.version("silver", "events").number] != [1, 1, 2, 2]:
        raise AssertionError(f"versions {counts}")
    return store.read("silver", "events").drop("ingested_at")


@query(sql="SELECT event_id, user_id, event_type, value FROM events")
def replayed_batch(spark: SparkSession, d: str) -> DataFrame:
    """A stream that forgets twice that a batch was done: once the batch is whole, once it lacks a file and is not finished."""
    events = table(spark, d, "events")
    store = scratch(spark)
    inbox, bronze = f"{store.root}/inbox", store.path("bronze", "events")
    commits = f"{store.root}/checkpoints/bronze/events/commits"
    for part in range(2):
        send(events.filter(F.col("event_id") % 2 == part), inbox)
        ingest_feed(store, EVENTS, "text", {"path": f"{inbox}/*"})
        delete_folder(spark, f"{commits}/{part}")
        if part:
            folder = f"{bronze}/{names_in(spark, bronze)[-1]}"
            delete_folder(spark, f"{folder}/_SUCCESS")
            day = next(n for n in names_in(spark, folder) if "=" in n)
            delete_folder(spark, f"{folder}/{day}/{names_in(spark, f'{folder}/{day}')[0]}")
        ingest_feed(store, EVENTS, "text", {"path": f"{inbox}/*"})
    return store.read("bronze", "events", EVENTS.bronze_schema).select("event_id", "user_id", "event_type", "value")


def _arrived(df: DataFrame, late: Column) -> DataFrame:
    """Rows with a time of ingestion: the late ones a day after the others."""
    day = F.when(late, "2024-01-02").otherwise("2024-01-01")
    return df.withColumn("ingested_at", day.cast("timestamp"))


@query(sql=ORACLES["country_fact"])
def incremental_gold(spark: SparkSession, d: str) -> DataFrame:
    """The country facts from silver tables to which late reports, appeals, yearly figures and places are added: made once
    without these, then brought up to date where they count. As if made of everything at once."""
    store = scratch(spark)
    reports = views.place_reports(spark, d)
    # Late are some reports of a third of the nations from 1998 on, and all of one nation.
    place = F.pmod(F.xxhash64("location_code"), F.lit(9))
    late = (place == 1) | ((place < 3) & (F.col("year") >= 1998) & (F.col("tax") > 2))
    reports = checkpointed(_arrived(reports, late))
    tables = {
        "conflict_events": views.conflict_events, "povertyrate": views.povertyrate, "foodsecurity": views.foodsecurity,
        "worldbank_mpm": views.wb_mpm, "worldbank_extreme_poverty": views.wb_extreme_poverty,
    }
    yearly, appeals = views.nation_year(spark, d), views.funding(spark, d).drop("ingested_at")
    last = yearly.agg(F.max("year")).first()[0]
    others = {
        "worldbank_population": _arrived(views.wb_population(spark, d), F.col("year") == last),
        "worldbank_gdp": _arrived(views.wb_gdp(spark, d), (F.col("year") == last) | (place == 2)),
        "funding": _arrived(appeals, (place == 4) & (F.col("o_orderkey") % 50 == 0)),
        "location": _arrived(views.location(spark, d), F.pmod(F.xxhash64("code"), F.lit(9)) == 5),
    }
    frames = {name: checkpointed(df) for name, df in others.items()}

    def silver(known: Column) -> None:
        own = reports.filter(known)
        for name, view in tables.items():
            # A yearly mean is one row, which a late report renews.
            rows = view(spark, d, own)
            if name.startswith("worldbank"):
                newest = own.groupBy("location_code", "year").agg(F.max("ingested_at").alias("ingested_at"))
                rows = rows.join(newest, ["location_code", "year"])
            store.overwrite(rows, "silver", name)
        for name, df in frames.items():
            store.overwrite(df.filter(known), "silver", name)

    arrived = F.col("ingested_at") < F.lit("2024-01-02").cast("timestamp")
    for known in (arrived, F.lit(True)):
        silver(known)
        made = refresh_facts(store)
    facts = store.read("gold", "gold_country_fact")
    if not 0 < made["gold_country_fact"].count() < facts.count():
        raise AssertionError("all rows were made again, or none")
    if refresh_facts(store):
        raise AssertionError("rows were made again without anything new")
    return rounded(facts)


@query(sql="SELECT event_id, user_id, event_type, value FROM events")
def late_field(spark: SparkSession, d: str) -> DataFrame:
    """A feed that learns of a field after half of the records have come, read with that field from all of them."""
    events = table(spark, d, "events")
    store = scratch(spark)
    fields = {path: name for path, name in EVENTS.mapping.items() if path != "kind"}
    before = replace(EVENTS, ddl="id BIGINT, user BIGINT, amount DOUBLE", mapping=fields)
    for part, feed in enumerate((before, EVENTS)):
        inbox = f"{store.root}/inbox"
        send(events.filter(F.col("event_id") % 2 == part), inbox)
        ingest_feed(store, feed, "text", {"path": f"{inbox}/*"})
        refresh_silver(store, feed)
    if store.read("silver", "events").filter("event_type IS NOT NULL").isEmpty():
        raise AssertionError("the field is unknown")
    bronze = store.read("bronze", "events", EVENTS.bronze_schema)
    return refine(bronze, EVENTS).drop("ingested_at")


@query(sql=ORACLES["quality_report"])
def partial_reports(spark: SparkSession, d: str) -> DataFrame:
    """The quality report of a table whose years came in two batches, the second of them renewing some of the first."""
    df = views.customer_year(spark, d).withColumn("repeat_orders", F.nullif("n_orders", F.lit(1)))
    store, columns = scratch(spark), ["repeat_orders", "amount_cents"]
    store.upsert(df.filter("year < 1998 OR o_custkey % 3 = 0"), "gold", "customers", mode="replace")
    options = {"columns": columns, "entity": "o_custkey", "period": "year", "means": ["n_orders"], "exact": True}
    refresh_partials(store, "gold", "customers", **options)
    store.upsert(df.filter("year >= 1998"), "gold", "customers", mode="replace")
    partials, pairs = refresh_partials(store, "gold", "customers", **options)
    return merged_quality(partials, columns, ["n_orders"], pairs)


@query(sql="""
    WITH sent AS (SELECT event_id, user_id % 3 AS partition, event_id // 4 % 2 AS segment, event_id % 10 = 0 AS gone, ts FROM events)
    SELECT CAST(partition AS INT) AS partition, CASE WHEN NOT gone THEN event_id END AS event_id,
           row_number() OVER (PARTITION BY partition ORDER BY segment, ts, CAST(event_id AS VARCHAR)) - 1 AS "offset"
    FROM sent""")
def kafka_shaped_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Events as a topic of three partitions in which every tenth message is a tombstone, taken in after each of two segments:
    every message once, with its offset."""
    events = table(spark, d, "events")
    store = scratch(spark)
    message = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("user")))
    messages = events.select(
        (F.col("user_id") % 3).alias("partition"), F.col("event_id").cast("string").alias("key"), F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 10 != 0, message).alias("value"), F.floor(F.col("event_id") / 4).alias("part"),
    )
    path = store.path("bronze", "events")
    for part in range(2):
        recorded.record_segment(messages.filter(F.col("part") % 2 == part), f"{store.root}/topics", "events")
        stream = read_stream(spark, "recorded", {"path": f"{store.root}/topics", "topic": "events"})
        rows = stream.select("partition", "offset", F.col("value").cast("string").alias("value"))
        append_stream(rows, path, f"{store.root}/checkpoint").awaitTermination()
    found = store.read("bronze", "events")
    return found.select("partition", "offset", F.get_json_object("value", "$.id").cast("bigint").alias("event_id"))


@query(sql="SELECT event_id, CAST(event_id % 3 + 1 AS INT) AS batch, true AS is_dated FROM events")
def stamped_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The time of ingestion of events that come in three micro-batches: one for all rows of a batch, later ones for later
    batches, and the day of it as the partition."""
    events = table(spark, d, "events")
    store, started = scratch(spark), F.lit(datetime.now(timezone.utc))
    for part in range(3):
        send(events.filter(F.col("event_id") % 3 == part), f"{store.root}/inbox")
        ingest_feed(store, EVENTS, "text", {"path": f"{store.root}/inbox/*"})
    bronze = store.read("bronze", "events", EVENTS.bronze_schema)
    stamps = bronze.select("ingested_at").distinct()
    order = F.sort_array(F.collect_list("ingested_at"))
    batch = F.array_position(stamps.agg(order).scalar(), F.col("ingested_at")).cast("int")
    dated = (F.col("ingested_on") == F.to_date("ingested_at")) & (F.col("ingested_at") >= started - F.expr("INTERVAL 1 SECOND"))
    return bronze.select("event_id", batch.alias("batch"), dated.alias("is_dated"))


@query(sql=views.with_ctes("population", body="""
    SELECT CAST(year AS INT) AS year, coo_iso, coo_name, coa_iso, coa_name, CAST(refugees AS INT) AS refugees,
           CAST(asylum_seekers AS INT) AS asylum_seekers, CAST(nullif(oip, 0) AS INT) AS oip, CAST(idps AS INT) AS idps
    FROM population"""))
def feed_population(spark: SparkSession, d: str) -> DataFrame:
    """Routes as messages of the feed ``population``, with quoted numbers and ``-`` for none, through its entry in the registry
    to its silver table: parsed, cleaned, placed and told apart by the feed's own rules. Some come twice, the second time right."""
    population, _ = views.routes(spark, d)
    feed, store = FEEDS["population"], scratch(spark)
    text = lambda c: F.col(c).cast("string").alias(c)
    none = F.when(F.col("oip") == 0, "-").otherwise(F.col("oip").cast("string")).alias("oip")
    names = ("coo_iso", "coo_name", "coa_iso", "coa_name")
    record = F.struct(text("year"), *names, "refugees", text("asylum_seekers"), none, "idps")
    wrong = F.struct("year", *names, F.lit(-1).alias("refugees"), F.lit("?").alias("asylum_seekers"))
    rows = checkpointed(population.filter("coo_iso IS NOT NULL AND coa_iso IS NOT NULL"))
    for messages in (rows.filter("year % 2 = 0").select(F.to_json(wrong).alias("value")), rows.select(F.to_json(record).alias("value"))):
        messages.write.text(f"{store.root}/inbox/{uuid4().hex}")
        ingest_feed(store, feed, "text", {"path": f"{store.root}/inbox/*"})
    refresh_silver(store, feed)
    return store.read("silver", feed.table).select("year", *names, "refugees", "asylum_seekers", "oip", "idps")
