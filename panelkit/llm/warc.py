"""Web archives: WARC records packed into ZIP files with an index, read by ranges without extraction.

One ZIP per task, its members stored, not compressed: ``archive/data.warc.gz``, each record a gzip member
of its own, and ``indexes/index.cdxj``, a line per record with its place in the archive. The reader
finds the members through the ZIP's directories (64-bit ones too) and reads records where they lie.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import text_or_empty
from panelkit.llm.files import new_file, new_folder, opened
from panelkit.sources.tables import checkpointed

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Smaller payloads are always stored in full.
LEAST_REVISIT = 100
#: Bytes of an archive that one task reads, and that it holds at once.
TASK_BYTES, READ_BYTES = 64 << 20, 8 << 20
_DATE = "2000-01-01T00:00:00Z"


def record(
    page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None
) -> bytes:
    """A WARC record; a revisit (``refers_to`` given) has the response's header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Target-URI": None if url is None else "".join(url.split()),
        "WARC-Date": _DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Refers-To": f"<urn:page:{refers_to}>" if revisit else None,
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes

    @classmethod
    def parse(cls, raw: bytes) -> Record:
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("no WARC record here")
        headers = dict(line.split(": ", 1) for line in lines)
        block = rest[: int(headers["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        return cls(headers, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload)

    @staticmethod
    def _page(name: str | None) -> int | None:
        digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    @property
    def page_id(self) -> int | None:
        return self._page(self.headers["WARC-Record-ID"])

    @property
    def refers_to(self) -> int | None:
        return self._page(self.headers.get("WARC-Refers-To"))


@dataclass(frozen=True)
class Member:
    name: str
    offset: int  # of its data
    size: int


class ZipDirectory:
    """The stored members of a ZIP file, found through its central directory."""

    # Fixed values of the ZIP format: signatures, sizes of the fixed parts, the number of the 64-bit field.
    _END, _END64, _LOCATOR, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
    _END_SIZE, _LOCATOR_SIZE, _END64_SIZE, _ENTRY_SIZE, _LOCAL_SIZE, _WIDE = 22, 20, 56, 46, 30, 1

    def __init__(self, file):
        self._file, size = file, file.size()
        tail_at = max(0, size - self._END_SIZE - 0xFFFF)
        tail = file.read_at(size - tail_at, tail_at)
        at = tail.rfind(self._END, 0, max(0, len(tail) - self._END_SIZE + len(self._END)))
        while at >= 0 and at + self._END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(self._END, 0, at)  # found in the comment behind the record
        if at < 0:
            raise ValueError("no ZIP directory here")
        count, length, start = struct.unpack_from("<HII", tail, at + 10)
        locator = tail_at + at - self._LOCATOR_SIZE
        if locator >= 0 and (found := file.read_at(self._LOCATOR_SIZE, locator))[:4] == self._LOCATOR:
            wide = file.read_at(self._END64_SIZE, struct.unpack_from("<Q", found, 8)[0])
            if wide[:4] != self._END64:
                raise ValueError("the 64-bit ZIP directory is damaged")
            count, length, start = struct.unpack_from("<QQQ", wide, 32)
        self._entries = {}
        directory, at = file.read_at(length, start), 0
        for _ in range(count):
            name, entry, at = self._entry(directory, at)
            self._entries[name] = entry

    def _entry(self, directory: bytes, at: int) -> tuple[str, tuple[int, int, int], int]:
        if directory[at : at + 4] != self._ENTRY:
            raise ValueError("the ZIP directory is damaged")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, size, name_size, extra_size, note_size = struct.unpack_from("<IIHHH", directory, at + 20)
        (local,) = struct.unpack_from("<I", directory, at + 42)
        extra_at = at + self._ENTRY_SIZE + name_size
        name = directory[at + self._ENTRY_SIZE : extra_at].decode("utf-8" if flags & 0x800 else "cp437")
        field, end = extra_at, extra_at + extra_size
        while field + 4 <= end:
            kind, width = struct.unpack_from("<HH", directory, field)
            if kind == self._WIDE:  # holds, in this order, only the values that do not fit their 32 bits
                wide = list(struct.unpack_from(f"<{width // 8}Q", directory, field + 4))
                size = wide.pop(0) if size == 0xFFFFFFFF else size
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            field += 4 + width
        return name, (method, size, local), end + note_size

    def names(self) -> list[str]:
        return list(self._entries)

    def member(self, name: str) -> Member:
        """Where a stored member's bytes are; its own header may have other fields than the directory."""
        method, size, local = self._entries[name]
        if method != zipfile.ZIP_STORED:
            raise ValueError(f"{name} is compressed; its parts cannot be read by range")
        head = self._file.read_at(self._LOCAL_SIZE, local)
        if head[:4] != self._LOCAL:
            raise ValueError(f"the header of {name} is damaged")
        name_size, extra_size = struct.unpack_from("<HH", head, 26)
        return Member(name, local + self._LOCAL_SIZE + name_size + extra_size, size)


def _write_archive(address_of, batches: Iterator[pa.RecordBatch]) -> dict | None:
    """One ZIP with the rows' records; what was written, or None without rows."""
    index, at, archive, member = [], 0, None, None
    for batch in batches:
        for row in batch.to_pylist():
            if archive is None:
                system, path, address = address_of()
                sink = system.open_output_stream(path)
                archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED)
                member = archive.open(ARCHIVE, "w", force_zip64=True)
            raw = record(row["page_id"], row["url"], row["payload"], row["digest"], row["size"], row["refers_to"])
            packed = gzip.compress(raw, 6, mtime=0)
            member.write(packed)
            index.append(json.dumps({"url": row["url"], "digest": row["digest"], "offset": at, "length": len(packed)}))
            at += len(packed)
    if archive is None:
        return None
    member.close()
    archive.writestr(INDEX, "\n".join(index))
    archive.close()
    sink.close()
    return {"address": address, "records": len(index), "bytes": at}


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html"
) -> DataFrame:
    """Write a record per page and return a row per archive: ``address``, ``records``, ``bytes``.

    Payloads are compared by SHA-256. Of those with the same digest and at least ``LEAST_REVISIT`` bytes the
    page with the smallest id is the response; the others, joined to it by digest (a join that
    adaptive execution splits where many pages are copies), become revisits without a payload.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "archives")
    payload = text_or_empty(html_column).cast("binary")
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        payload.alias("payload")
    )
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    responses = rows.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("response"), F.count(F.lit(1)).alias("n")
    )
    responses = checkpointed(responses.filter("n > 1").drop("n"))
    linked = rows.join(responses, "digest", "left")
    refers_to = F.when(~F.col("response").eqNullSafe(F.col("page_id")), F.col("response"))
    linked = linked.select(
        "page_id", "url", F.when(
            refers_to.isNull(), F.col("payload")
        ).alias("payload"), "digest", "size", refers_to.alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = _write_archive(lambda: new_file(folder, ".wacz"), batches)
        if done:
            yield pa.RecordBatch.from_pylist([done])

    return checkpointed(linked.mapInArrow(write, "address string, records long, bytes long"))


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record: ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``payload``.

    A first pass reads directories and indexes and cuts each archive into ranges of records, a
    second one reads the ranges, each in a task's own turn. Payloads are held against their digests.
    """

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column("address").to_pylist():
                system, path = opened(address)
                with system.open_input_file(path) as file:
                    directory = ZipDirectory(file)
                    index, archive = directory.member(INDEX), directory.member(ARCHIVE)
                    entries = [json.loads(line) for line in file.read_at(index.size, index.offset).decode().split("\n")]
                parts: list[dict] = []
                for entry in entries:
                    if not parts or sum(parts[-1]["lengths"]) >= TASK_BYTES:
                        parts.append({"address": address, "offset": archive.offset + entry["offset"], "lengths": []})
                    parts[-1]["lengths"].append(entry["length"])
                yield pa.RecordBatch.from_pylist(parts)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                system, path = opened(part["address"])
                with system.open_input_file(path) as file:
                    yield from _read_range(file, part["offset"], part["lengths"])

    found = archives.select("address").mapInArrow(ranges, "address string, offset long, lengths array<long>")
    many, size = archives.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    return found.repartition(max(1, many + (size or 0) // TASK_BYTES), "address", "offset").mapInArrow(
        records, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )


def _read_range(file, offset: int, lengths: list[int]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    first = 0
    while first < len(lengths):
        last, size = first + 1, lengths[first]
        while last < len(lengths) and size + lengths[last] <= READ_BYTES:
            size += lengths[last]
            last += 1
        block, at, rows = memoryview(file.read_at(size, offset)), 0, []
        for length in lengths[first:last]:
            found = Record.parse(gzip.decompress(block[at : at + length]))
            digest = found.headers["WARC-Payload-Digest"].removeprefix("sha256:")
            kind = found.headers["WARC-Type"]
            if kind == "response" and hashlib.sha256(found.payload).hexdigest() != digest:
                raise ValueError(f"payload of page {found.page_id} does not have its digest")
            rows.append(
                (
                    found.page_id,
                    found.headers.get("WARC-Target-URI"),
                    int(found.http["Content-Length"]),
                    digest,
                    kind,
                    found.refers_to,
                    found.payload if kind == "response" else None
                )
            )
            at += length
        columns = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
        offset += size
        first = last


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write the pages into archives in the shared folder and report every record as read back.

    NULL html is an empty payload. A page with NULL id refers to the smallest id of its copies and is never
    referred to unless there is no other; pages that repeat an id are all responses if it is the smallest
    (a record never refers to its own id). An empty table writes nothing and gives no rows.
    """
    return read_archives(write_archives(pages)).drop("payload")
