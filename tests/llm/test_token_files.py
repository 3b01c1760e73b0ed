import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from panelkit.llm import token_files
from panelkit.llm.perfect_hash import PerfectHash, build
from panelkit.llm.token_files import encoded_documents, look_up, read_documents, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_perfect_hash_numbers_each_key_once():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 10, 5000):
        keys = np.unique(rng.integers(-(2**63), 2**63 - 1, n)).view(np.uint64)
        numbers = PerfectHash(build(keys)).numbers(keys)
        assert sorted(numbers.tolist()) == list(range(len(keys)))


def test_round_trip(docs, sample, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_ROWS", 30)
    rows = [(r["doc_id"], r["text"]) for r in sample("documents")][:150]
    rows += [(-7, "negative"), (10**6, None), (10**6 + 1, ""), (10**6 + 2, "long text " * 30_000)]
    found = {r.doc_id: r for r in encoded_documents(docs(rows), PATH).collect()}
    start = 0
    for i, text in sorted(rows):
        own = ids(text)
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (
            start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())
        )
        start += len(own)
    assert len(found) == len(rows)


def test_look_up_by_key(spark, docs, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_ROWS", 10)
    rows = [(3 * i, f"text number {i} of all") for i in range(60)] + [(9, "the same id again")]
    files = write_token_files(docs(rows), PATH)
    keys = spark.createDataFrame([(0,), (9,), (10,), (177,), (10**9,)], "doc_id long")
    got = sorted((r.doc_id, r.ids) for r in look_up(files, keys).collect())
    assert got == sorted(
        [(0, ids(rows[0][1])), (9, ids(rows[3][1])), (9, ids("the same id again")), (177, ids(rows[59][1]))]
    )


def test_null_and_repeated_ids_and_empty_table(docs):
    rows = [(None, "b"), (None, "b"), (4, "x"), (4, "x"), (1, "a b c")]
    found = sorted(
        ((r.doc_id, r.start, r.n_tokens) for r in encoded_documents(docs(rows), PATH).collect()), key=lambda r: r[1]
    )
    assert [r[0] for r in found] == [None, None, 1, 4, 4]
    assert [r[1] for r in found] == [0, *np.cumsum([r[2] for r in found])[:-1]]
    assert read_documents(write_token_files(docs([]), PATH)).count() == 0


def test_a_key_over_several_reads(docs, monkeypatch):
    monkeypatch.setattr(token_files, "READ_IDS", 7)
    rows = [(None, "a b")] * 3 + [(-5, "c")] + [(2, f"d {i} e") for i in range(9)] + [(3, "f")]
    files = write_token_files(docs(rows), PATH)
    found = sorted((r.start, r.doc_id, r.n_tokens) for r in read_documents(files).collect())
    assert [r[1] for r in found] == [None] * 3 + [-5] + [2] * 9 + [3]
    assert [r[0] for r in found] == [0, *np.cumsum([r[2] for r in found])[:-1]]


def test_documents_come_through_the_index(docs):
    """An index whose entries are changed gives other rows, or none."""
    import pytest

    rows = [(i, f"text {i} " * (i + 1)) for i in range(20)]
    files = write_token_files(docs(rows), PATH)
    path = files.first().address.removeprefix("file:")
    with open(path, "rb") as file:
        whole = bytearray(file.read())
    end = len(whole) - 16 - int.from_bytes(whole[-16:-8], "little")
    begin = end - token_files._ENTRY.itemsize * 20
    entries = np.frombuffer(bytes(whole[begin:end]), token_files._ENTRY).copy()
    entries["first"] = np.roll(entries["first"], 1)
    whole[begin:end] = entries.tobytes()
    with open(path, "wb") as file:
        file.write(whole)
    with pytest.raises(Exception, match="misses a document"):
        read_documents(files).collect()


def test_addresses_that_hadoop_knows():
    from panelkit.llm import files

    assert files.arrow_address("s3a://bucket/x") == "s3://bucket/x"
