"""Recorded topics: messages kept in files with the columns, offsets and tombstones that Kafka gives them.

For feeds that are archived, and to replay what a broker has forgotten. A topic is recorded in segments: Parquet files by
partition, and a small file that names the next offset of every partition. The streaming source ``recorded`` reads them with
Kafka's columns; its offsets are those of the messages, so a stream resumes at the message after its last.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from panelkit.sources import storage
from panelkit.sources.storage import arrow_address, create_text, names_in, read_text

SCHEMA = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT"
_ENDS, _DATA = "ends", "data"
#: What Kafka calls the time at which a message was made.
_CREATE_TIME = 0
_ARROW = pa.schema([
    ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
    ("timestamp", pa.timestamp("us", "UTC")), ("timestampType", pa.int32()),
])


def record_segment(messages: DataFrame, folder: str, topic: str, partitions: int = 1) -> dict[int, int]:
    """Append messages to a recorded topic; returns the next offset of each partition.

    ``messages`` have ``value`` (NULL for a tombstone) and may have ``key``, ``timestamp`` and ``partition``; without the latter
    messages go by a hash of their key. They are numbered in the order of their time, key and value. A segment counts
    once its offsets are written; of two recorders at once one fails.
    """
    spark, root = messages.sparkSession, f"{folder.rstrip('/')}/{topic}"
    names = names_in(spark, f"{root}/{_ENDS}")
    before = _ends_of(read_text(spark, f"{root}/{_ENDS}/{names[-1]}")) if names else {}
    number = int(names[-1]) + 1 if names else 0
    have = messages.columns
    rows = messages.select(
        (F.col("key") if "key" in have else F.lit(None)).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        (F.col("timestamp").cast("timestamp") if "timestamp" in have else F.current_timestamp()).alias("timestamp"),
        (F.col("partition").cast("int") if "partition" in have else F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"))
        .alias("partition"),
    )
    along = Window.partitionBy("partition").orderBy("timestamp", "key", "value")
    first = F.coalesce(F.create_map(*[F.lit(x) for p, end in before.items() for x in (p, end)])[F.col("partition")], F.lit(0)) if before else F.lit(0)
    data = f"{root}/{_DATA}/{number:012d}"
    numbered = rows.withColumn("offset", (first + F.row_number().over(along) - 1).cast("long"))
    numbered.write.mode("overwrite").partitionBy("partition").parquet(data)
    written = spark.read.parquet(data) if any("=" in n for n in names_in(spark, data)) else None
    ends = dict(before)
    if written is not None:
        ends |= {int(r["partition"]): r.end for r in written.groupBy("partition").agg((F.max("offset") + 1).alias("end")).collect()}
    if not create_text(spark, f"{root}/{_ENDS}/{number:012d}", json.dumps(ends)):
        raise RuntimeError(f"another recorder wrote segment {number} of {root}")
    return ends


def _ends_of(text: str) -> dict[int, int]:
    return {int(p): end for p, end in json.loads(text).items()}


def _opened(address: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(arrow_address(address))


class Stretch(InputPartition):
    """Messages of one partition from an offset up to another, in some segments."""

    def __init__(self, partition: int, first: int, end: int, segments: list[str]):
        self.partition, self.first, self.end, self.segments = partition, first, end, segments


class RecordedReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.topic = options["topic"]
        self.root = f"{options['path'].rstrip('/')}/{self.topic}"
        self.latest = options.get("startingOffsets", "earliest") == "latest"
        self.seen: dict[str, dict[int, int]] = {}

    def _segments(self) -> list[tuple[str, dict[int, int]]]:
        """Each segment's name and the offsets after it, in order; a segment's file is read once."""
        system, path = _opened(f"{self.root}/{_ENDS}")
        for info in system.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
            if info.base_name.isdigit() and info.base_name not in self.seen:
                with system.open_input_stream(info.path) as stream:
                    self.seen[info.base_name] = _ends_of(stream.readall().decode())
        return sorted(self.seen.items())

    def initialOffset(self) -> dict:
        return self.latestOffset() if self.latest else {}

    def latestOffset(self) -> dict:
        segments = self._segments()
        return {str(p): end for p, end in segments[-1][1].items()} if segments else {}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        found, segments = [], self._segments()
        for name, last in sorted((int(p), e) for p, e in end.items()):
            first, before, own = start.get(str(name), 0), 0, []
            for segment, ends in segments:
                after = ends.get(name, 0)
                if before < last and after > first and after > before:
                    own.append(segment)
                before = after
            if first < last:
                found.append(Stretch(name, first, last, own))
        return found

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        inside = (ds.field("offset") >= partition.first) & (ds.field("offset") < partition.end)
        for segment in partition.segments:
            system, path = _opened(f"{self.root}/{_DATA}/{segment}/partition={partition.partition}")
            files = ds.dataset(path, filesystem=system, format="parquet", partitioning=None)
            rows = files.to_table(columns=["key", "value", "offset", "timestamp"], filter=inside).sort_by("offset")
            for batch in rows.to_batches(max_chunksize=10_000):
                n = len(batch)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"), batch.column("value"), pa.repeat(pa.scalar(self.topic), n),
                        pa.repeat(pa.scalar(partition.partition, pa.int32()), n), batch.column("offset"),
                        batch.column("timestamp").cast(pa.timestamp("us", "UTC")), pa.repeat(pa.scalar(_CREATE_TIME, pa.int32()), n),
                    ],
                    schema=_ARROW,
                )


class RecordedTopic(DataSource):
    """``spark.readStream.format("recorded")`` with the options ``path`` and ``topic``, after ``register``."""

    @classmethod
    def name(cls) -> str:
        return "recorded"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> RecordedReader:
        return RecordedReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the source known to a session. Its classes travel with it, so workers need not have this package."""
    for module in (sys.modules[__name__], storage):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(RecordedTopic)
