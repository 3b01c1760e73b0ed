"""Raw messages to bronze tables with Structured Streaming.

Stateless: each micro-batch is parsed and stamped without a shuffle and written into a folder of its own, named by the stream
and the batch's number. A batch that is run again after a failure finds its folder finished or writes it anew, so a
rerun continues where the last one stopped and no row comes twice.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelkit.sources import recorded
from panelkit.sources.batches import batch_name, finished
from panelkit.sources.feeds import BAD_RECORD, INGESTED_AT, INGESTED_ON, UNKNOWN, FeedSpec
from panelkit.sources.records import parse_json_records, stamp_ingested
from panelkit.sources.storage import read_text
from panelkit.sources.tables import TableStore


def read_stream(spark: SparkSession, source: str, options: Mapping[str, str], schema=None) -> DataFrame:
    """A stream of raw messages in a ``value`` column.

    ``source`` is any streaming format: ``kafka`` (reads from the earliest offset unless told
    otherwise), ``recorded`` (a topic kept in files, with Kafka's columns and offsets), or ``text``, ``json``, ``parquet``
    with the folder under the option ``path``.
    """
    if source == recorded.RecordedTopic.name():
        recorded.register(spark)
    reader = spark.readStream.format(source)
    if source == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load()


def parse_stream(messages: DataFrame, feed: FeedSpec, compat: bool = False) -> DataFrame:
    """Messages of a feed as typed, renamed, stamped rows; the text of records that are no JSON is kept, and so are
    fields that the feed's schema does not know."""
    return stamp_ingested(
        parse_json_records(messages, feed.schema, feed.mapping, compat=compat, raw_out=BAD_RECORD, rest_out=UNKNOWN)
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """What tells a stream from others: its id, which Spark keeps in the checkpoint for as long as that is there."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"].replace("-", "")


def write_batch(rows: DataFrame, path: str, stream: str, number: int, partition_by: Sequence[str] = ()) -> None:
    """Write one micro-batch into its folder; one that is finished is left as it is."""
    spark, folder = rows.sparkSession, batch_name(stream, number)
    if not finished(spark, path, folder):
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path.rstrip('/')}/{folder}")


def append_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything not yet processed to a Parquet table of batches, then stop.

    Stamped rows are partitioned by the day they came, so that reading a time opens no older file.
    """
    by_day = [INGESTED_ON] if INGESTED_AT in df.columns else []
    rows = df.withColumn(INGESTED_ON, F.to_date(INGESTED_AT)) if by_day else df

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, path, _stream_id(batch.sparkSession, checkpoint), number, by_day)

    return (
        rows.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_ingest(
    store: TableStore, feed: FeedSpec, source: str, options: Mapping[str, str], compat: bool = False
) -> StreamingQuery:
    """Start to bring a feed's bronze table up to date.

    For Kafka and recorded topics the feed's topic is read unless the options name another.
    """
    if source == "kafka":
        options = {"subscribe": feed.topic, **options}
    elif source == recorded.RecordedTopic.name():
        options = {"topic": feed.topic, **options}
    rows = parse_stream(read_stream(store.spark, source, options), feed, compat)
    checkpoint = f"{store.root.rstrip('/')}/checkpoints/bronze/{feed.table}"
    return append_stream(rows, store.path("bronze", feed.table), checkpoint)


def ingest_feed(
    store: TableStore, feed: FeedSpec, source: str, options: Mapping[str, str], compat: bool = False
) -> None:
    """Bring a feed's bronze table up to date and wait until that is done."""
    start_ingest(store, feed, source, options, compat).awaitTermination()
