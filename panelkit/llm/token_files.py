"""Token ids in binary files with constant-time access by document key.

One file per range of ids, documents in ascending id order, NULL ids first. Layout, little-endian:

    b"TOKENIDS"                       magic
    payload                           ids of all documents, 16 bits each where the vocabulary allows, else 32
    keys      int64[n]                document ids (0 where NULL)
    bounds    int64[n + 1]            where each document's ids begin, and the end, counted in ids
    index     levels of bits          minimal perfect hash of the distinct keys
    entries   (uint32, int64, int64)  by hash number: fingerprint, first document with the key, how many
    footer    JSON, its length as int64, magic again
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelkit.llm.files import new_file, new_folder, opened
from panelkit.llm.perfect_hash import PerfectHash, build, mixed
from panelkit.llm.word_ids import word_ids

MAGIC = b"TOKENIDS"
#: Ids that a reader holds at once, unless one document is longer.
READ_IDS = 1 << 21
#: Rows of the input that go into one file.
FILE_ROWS = 20_000
_ENTRY = np.dtype([("fingerprint", "<u4"), ("first", "<i8"), ("count", "<i8")])
_FINGERPRINT_SEED = 1_000


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, _FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)


class TokenFileWriter:
    def __init__(self, sink, width: int):
        self._sink, self._kind = sink, np.dtype(f"<u{width}")
        self._keys: list[int] = []
        self._nulls = 0
        self._bounds = [0]
        sink.write(MAGIC)

    def add(self, key: int | None, ids: bytes) -> None:
        values = np.frombuffer(ids, "<u4")
        self._sink.write(values.astype(self._kind).tobytes())
        self._nulls += key is None
        self._keys.append(key or 0)
        self._bounds.append(self._bounds[-1] + len(values))

    def close(self) -> dict:
        keys = np.array(self._keys, "<i8")
        given = keys[self._nulls :]
        distinct, first, count = np.unique(given, return_index=True, return_counts=True)
        levels = build(distinct.view(np.uint64))
        entries = np.zeros(len(distinct), _ENTRY)
        at = PerfectHash(levels).numbers(distinct.view(np.uint64))
        entries["fingerprint"][at] = _fingerprints(distinct.view(np.uint64))
        entries["first"][at] = first + self._nulls
        entries["count"][at] = count
        footer = json.dumps(
            {
                "width": self._kind.itemsize,
                "documents": len(keys),
                "nulls": self._nulls,
                "levels": [len(x) for x in levels],
                "entries": len(entries)
            }
        ).encode()
        for part in (
            keys.tobytes(),
            np.array(self._bounds, "<i8").tobytes(),
            *(x.tobytes() for x in levels),
            entries.tobytes(),
            footer,
            len(footer).to_bytes(8, "little"),
            MAGIC
        ):
            self._sink.write(part)
        return {
            "n_docs": len(keys),
            "n_ids": self._bounds[-1],
            "nulls": self._nulls,
            "first_key": int(given[0]) if len(given) else None,
            "last_key": int(given[-1]) if len(given) else None
        }


class TokenFile:
    """Reads one file; the payload only where it is asked for."""

    def __init__(self, address: str):
        system, path = opened(address)
        self._file = system.open_input_file(path)
        size = self._file.size()
        tail = self._file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{address} is no complete token file")
        footer = int.from_bytes(tail[:8], "little")
        meta = json.loads(self._file.read_at(footer, size - 16 - footer))
        self._kind, n = np.dtype(f"<u{meta['width']}"), meta["documents"]
        lengths = [8 * n, 8 * n + 8, *meta["levels"], _ENTRY.itemsize * meta["entries"]]
        whole = self._file.read_at(sum(lengths), size - 16 - footer - sum(lengths))
        parts = np.split(np.frombuffer(whole, np.uint8), np.cumsum(lengths)[:-1])
        self.nulls = meta["nulls"]
        self.keys, self.bounds = parts[0].view("<i8"), parts[1].view("<i8")
        self._hash = PerfectHash(parts[2:-1])
        self._entries = np.frombuffer(parts[-1].tobytes(), _ENTRY)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; the number is 0 for keys not in the file."""
        keys = keys.astype(np.int64).view(np.uint64)
        at = self._hash.numbers(keys)
        if not len(self._entries):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        entry = self._entries[np.maximum(at, 0)]
        same = (at >= 0) & (entry["fingerprint"] == _fingerprints(keys))
        same &= self.keys[entry["first"]].view(np.uint64) == keys
        return np.where(same, entry["first"], 0), np.where(same, entry["count"], 0)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids from document ``first`` up to, not including, ``last``."""
        begin, end = int(self.bounds[first]), int(self.bounds[last])
        width = self._kind.itemsize
        return np.frombuffer(self._file.read_at((end - begin) * width, len(MAGIC) + begin * width), self._kind)

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Runs of documents that together have about READ_IDS ids."""
        first, n = 0, len(self.keys)
        while first < n:
            last = int(np.searchsorted(self.bounds, self.bounds[first] + READ_IDS, "right")) - 1
            last = min(max(last, first + 1), n)
            yield first, last
            first = last

    def close(self) -> None:
        self._file.close()


_FILES = "address string, n_docs long, n_ids long, nulls long, first_key long, last_key long"


def write_token_files(
    df: DataFrame, tokenizer: str, folder: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write the documents' ids; returns a row per file with ``base``, the ids in all files before it.

    Texts move once, into ranges of ids that are sorted and encoded where they arrive. The list of
    files (one row each) passes through the driver, which numbers them.
    """
    spark = df.sparkSession
    folder = folder or new_folder(spark, "token-files")
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    files = max(1, -(-rows.select("id").count() // FILE_ROWS))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, writer = word_ids(tokenizer), None
        for batch in batches:
            if writer is None:
                system, path, address = new_file(folder, ".ids")
                sink = system.open_output_stream(path)
                writer = TokenFileWriter(sink, 2 if words.largest < 1 << 16 else 4)
            for key, text in zip(batch.column(0), batch.column(1)):
                writer.add(key.as_py(), words.document(text.as_py()))
        if writer is not None:
            done = {"address": address} | writer.close()
            sink.close()
            yield pa.RecordBatch.from_pylist(
                [done], pa.schema([("address", pa.string()), *((k, pa.int64()) for k in list(done)[1:])])
            )

    written = rows.repartitionByRange(
        files, F.col("id").asc_nulls_first()
    ).sortWithinPartitions(F.col("id").asc_nulls_first()).mapInArrow(write, _FILES)
    found = sorted(written.collect(), key=lambda r: (r.first_key is not None and not r.nulls, r.first_key or 0))
    base, listed = 0, []
    for row in found:
        listed.append((*row, base))
        base += row.n_ids
    return spark.createDataFrame(
        listed, StructType([*written.schema, StructField("base", LongType())])
    ).repartition(max(1, len(listed)))


def read_documents(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per document in the files: id, ``start``, ``n_tokens``, ``ids_crc32``.

    Each document is reached by its key: the hash index says where the documents with the key are, and the offsets there
    where their ids are. Only NULL keys, which have no hash, go by their place. A key that the index does not
    find, or not as often as it is there, is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source = TokenFile(row["address"])
                last_key, before = None, 0  # of the block before: its last key, and how often that has come
                for first, last in source.blocks():
                    keys = source.keys[first:last]
                    at, count = source.find(keys)
                    places = np.arange(first, last)
                    given = places >= source.nulls
                    again = np.zeros(len(keys), np.int64)  # how often the key has come before
                    own = keys[given]
                    again[given] = np.arange(len(own)) - np.searchsorted(own, own)
                    if first > source.nulls and own[0] == last_key:
                        again[keys == last_key] += before
                    last_key, before = keys[-1], again[-1] + 1
                    if not (again < count)[given].all():
                        raise ValueError(f"the index of {row['address']} misses a document")
                    at = np.where(given, at + again, places)
                    low, high = int(at.min()), int(at.max()) + 1
                    ids = source.ids(low, high).astype("<u4")
                    begin, end = source.bounds[at], source.bounds[at + 1]
                    offset = int(source.bounds[low])
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip((begin - offset).tolist(), (end - offset).tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.int64(), mask=~given),
                            pa.array(row["base"] + begin),
                            pa.array(end - begin),
                            pa.array(crc, pa.int64())
                        ],
                        names=["id", "start", "n_tokens", "ids_crc32"],
                    )
                source.close()

    return files.mapInArrow(
        read, "id long, start long, n_tokens long, ids_crc32 long"
    ).withColumnRenamed("id", id_column)


def look_up(files: DataFrame, keys: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The ids of the documents with the given keys: id, ``ids``; keys not in the files give no row.

    Keys find their file by its first and last key, then their documents in constant time each.
    """
    near = keys.select(F.col(id_column).cast("long").alias("id")).join(
        F.broadcast(
            files.select("address", "first_key", "last_key")
        ), F.col("id").between(F.col("first_key"), F.col("last_key"))
    )

    def read(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        source, found, ids = TokenFile(key[0].as_py()), [], []
        wanted = table.column("id").to_numpy()
        for k, first, count in zip(wanted, *source.find(wanted)):
            for at in range(first, first + count):
                found.append(k)
                ids.append(source.ids(at, at + 1).astype(np.int64))
        source.close()
        return pa.table({"id": pa.array(found, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64()))})

    return near.select("address", "id").groupBy("address").applyInArrow(
        read, "id long, ids array<long>"
    ).withColumnRenamed("id", id_column)


def encoded_documents(df: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write token files into the shared folder and report each document as read back from them.

    NULL text is empty and holds the end id alone. NULL ids come first, repeated ids stay separate
    documents in no particular order, an empty table gives no rows; other columns are not looked at.
    """
    return read_documents(write_token_files(df, tokenizer, None, id_column, text_column), id_column)
