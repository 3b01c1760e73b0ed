"""Raw tables: a folder per batch, written once, and how far a reader has come.

A batch is named by the stream that wrote it and its number there. A stream writes its batches one after the other, so only its
newest may be unfinished; it is finished when Spark's ``_SUCCESS`` file is in it. There is no list of all files: a
reader lists the names of the batches and opens those it has not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from panelkit.sources.storage import exists, names_in

BATCH = "_batch"


def batch_name(stream: str, number: int) -> str:
    return f"{BATCH}={stream}-{number:012d}"


def _place(name: str) -> tuple[str, int]:
    stream, _, number = name.partition("=")[2].rpartition("-")
    return stream, int(number)


def finished(spark: SparkSession, path: str, folder: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{folder}/_SUCCESS")


def names(spark: SparkSession, path: str) -> list[str]:
    """The finished batches of a raw table, by stream and number."""
    found = [n for n in names_in(spark, path) if n.startswith(f"{BATCH}=")]
    newest = {_place(n)[0]: n for n in found}
    return [n for n in found if newest[_place(n)[0]] != n or finished(spark, path, n)]


def unread(found: Sequence[str], marks: Mapping[str, int]) -> list[str]:
    """The batches beyond what a reader has read, the last number of each stream."""
    return [n for n in found if _place(n)[1] > marks.get(_place(n)[0], -1)]


def marks_of(found: Sequence[str]) -> dict[str, int]:
    """How far a reader of these batches has come."""
    marks: dict[str, int] = {}
    for stream, number in map(_place, found):
        marks[stream] = max(number, marks.get(stream, -1))
    return marks


def read(
    spark: SparkSession, path: str, schema: StructType | None = None, chosen: Sequence[str] | None = None
) -> DataFrame:
    """The rows of finished batches (all, or those chosen); of a folder without batches, all of its rows."""
    root = path.rstrip("/")
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    found = names(spark, path) if chosen is None else list(chosen)
    if chosen is None and not any(n.startswith(f"{BATCH}=") for n in names_in(spark, path)):
        return reader.parquet(path)
    if not found and schema:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", root).parquet(*[f"{root}/{n}" for n in found]).drop(BATCH)
