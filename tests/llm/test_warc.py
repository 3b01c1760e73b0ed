import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from panelkit.llm import warc
from panelkit.llm.warc import Record, ZipDirectory, archived_pages, read_archives, record, write_archives

PAGES = "page_id long, url string, html string, id string, digest string, size string, n string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], PAGES)


def brute(rows):
    found = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if j is not None and (h or "").encode() == data]
        first = min(same, default=None)
        revisit = len(data) >= 100 and first is not None and i != first
        found.append(
            (
                i,
                len(data),
                hashlib.sha256(data).hexdigest(),
                "revisit" if revisit else "response",
                first if revisit else None
            )
        )
    return sorted(found, key=str)


def result(df):
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str
    )


ROWS = [
    (4, "http://a", "é" * 60), (2, "http://b", "é" * 60), (9, None, "é" * 60), (1, "http://c", "short"), (3, "http://d\n", "short"), (5, "", None),
    (6, "http://e", ""), (7, "http://f", "x" * 99), (8, "http://g", "x" * 99), (
        10, "http://h", "\r\n\r\n" * 50
    ), (11, "http://i", "y" * 400_000),
    (None, "http://j", "é" * 60), (None, "http://k", "z" * 200), (12, "http://l", "same" * 50), (12, "http://l", "same" * 50),
]


def test_as_brute_force(spark):
    assert result(archived_pages(pages(spark, ROWS))) == brute(ROWS)


def test_payloads_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK_BYTES", 200)
    found = read_archives(write_archives(pages(spark, ROWS)))
    payloads = {r.page_id: (r.record_type, r.payload) for r in found.collect() if r.page_id is not None}
    for i, _, html in ROWS:
        if i is not None:
            kind, payload = payloads[i]
            assert (payload is None) if kind == "revisit" else bytes(payload) == (html or "").encode()


def test_empty_table(spark):
    assert archived_pages(pages(spark, [])).count() == 0


class File:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at : at + n]


@pytest.mark.parametrize("limit", [None, 10])
def test_directories_with_and_without_64_bit_fields(monkeypatch, limit):
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as archive:
        archive.comment = b"PK\x05\x06 not the end"
        archive.writestr("first", b"a" * 50)
        with archive.open("dir/second", "w", force_zip64=True) as member:
            member.write(b"second member")
        archive.writestr("packed", b"b" * 50, zipfile.ZIP_DEFLATED)
    file = File(sink.getvalue())
    directory = ZipDirectory(file)
    assert directory.names() == ["first", "dir/second", "packed"]
    for name, data in (("first", b"a" * 50), ("dir/second", b"second member")):
        member = directory.member(name)
        assert file.read_at(member.size, member.offset) == data
    with pytest.raises(ValueError, match="compressed"):
        directory.member("packed")
    with pytest.raises(ValueError, match="no ZIP"):
        ZipDirectory(File(b"nothing here"))


def test_archives_are_plain_zip_files(spark):
    import gzip

    (row, *_) = write_archives(pages(spark, ROWS[:4])).collect()
    system, path = warc.opened(row.address)
    data = system.open_input_file(path).read()
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        assert archive.testzip() is None
        assert gzip.decompress(archive.read(warc.ARCHIVE)).startswith(b"WARC/1.1\r\n")


def test_record_round_trip():
    raw = record(5, "http://x y", b"body\r\n\r\nmore", "d" * 64, 12, None)
    got = Record.parse(raw)
    assert (
        got.page_id, got.refers_to, got.payload, got.headers["WARC-Target-URI"]
    ) == (5, None, b"body\r\n\r\nmore", "http://xy")
    assert Record.parse(record(6, None, None, "d" * 64, 12, 5)).refers_to == 5
    assert pa.__version__
