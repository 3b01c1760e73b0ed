"""Fingerprints against plain Python: the same cells, and likeness by counting paragraphs."""

import hashlib
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from panelkit.llm import fingerprints as module
from panelkit.llm.fingerprints import CELLS, LINE, ROWS, fingerprints, peeled, sketch

PIECE = re.compile(rf"[^\n]{{{LINE},}}?[.!?。！？]+(?=[ \t\n\x0b\f\r])|[^\n]+")
MASK = 0x7FFFFFFFFFFFFFFE


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def pieces(text):
    return [p for p in PIECE.findall(text) if re.search(r"[^ \t\n\x0b\f\r]", p)]


def plain_digests(text):
    found = []
    for piece, times in Counter(pieces(text)).items():
        first = xxhash.xxh64_intdigest(struct.pack("<Q", xxhash.xxh64_intdigest(piece.encode(), 42)), 42)
        found += [xxhash.xxh64_intdigest(struct.pack("<i", k), first) & MASK for k in range(times)]
    return found


def plain_sketch(text):
    cells = [[0, 0, 0] for _ in range(ROWS * CELLS)]
    for d in plain_digests(text):
        for row in range(ROWS):
            cell = cells[row * CELLS + ((d >> (1 + 2 * row)) & (CELLS - 1))]
            cell[0] += 1
            cell[1] ^= d
            cell[2] ^= xxhash.xxh64_intdigest(struct.pack("<Q", d), 42) & 0xFFFFFFFF
    return "".join(f"{n:08x}{key:016x}{check:08x}" for n, key, check in cells)


def likeness(a, b):
    a, b = Counter(pieces(a)), Counter(pieces(b))
    every = sum((a | b).values())
    return sum((a & b).values()) / every if every else 1.0


def brute(rows):
    rows = [(i, t or "") for i, t in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), 42))), reverse=True)
    found = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        found.append((
            i, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_sketch(text), plain_sketch(edited),
            likeness(text, edited), likeness(text, after),
        ))
    return sorted(found, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def text_of(rng, n):
    pool = [f"Line number {k} of all." for k in range(12)]
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(rng.randint(1, 70))) + "."
    return "\n".join(rng.choice(pool) if rng.random() < 0.4 else own() for _ in range(n))


def test_as_plain_python(docs, monkeypatch):
    monkeypatch.setattr(module, "PART_ROWS", 6)
    rng = random.Random(11)
    rows = [(3 * i, text_of(rng, rng.choice([1, 2, 5, 30]))) for i in range(50)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t\n"), (1003, "ä漢🙂" * 9), (1004, "same\n" * 40), (1005, "same\n" * 41)]
    rows += [(None, rows[3][1]), (None, "null id"), (6, rows[4][1]), (9, rows[3][1]), (9, rows[3][1])]
    rows += [(2000, text_of(rng, 1500)), (2001, " ".join("A sentence that is long enough to count for itself." for _ in range(300)))]
    rows += [(3000 + i, rows[0][1]) for i in range(9)]
    found = fingerprints(docs(rows))
    assert found.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    ]
    assert result(found) == brute(rows)


def test_driver_documents(docs, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample("documents")]
    found = result(fingerprints(docs(rows)))
    assert found == brute(rows)
    several = [r for r in found if r[5] > r[6]]
    assert len(several) > 0.8 * len(found)


def test_small_tables(docs):
    assert fingerprints(docs([])).collect() == []
    for rows in ([(1, "one line\nand two")], [(5, None)], [(None, "x"), (None, "x")], [(1, "abc"), (2, "wxyz")]):
        assert result(fingerprints(docs(rows))) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 60])
def test_peeling_tells_whether_it_is_done(spark, n):
    """A sketch of few digests gives all back; one that is too small says so."""
    rng = random.Random(n)
    own = [rng.getrandbits(62) << 1 | rng.getrandbits(1) for _ in range(n)]
    got = spark.createDataFrame([(own,)], "own array<long>").select(peeled(sketch(F.col("own"))).alias("p")).first().p
    if n <= 2:
        assert (got.plus, got.minus, got.done) == (sum(not d & 1 for d in own), sum(d & 1 for d in own), True)
    else:
        assert not got.done


def test_no_python_on_the_way(docs):
    plan = fingerprints(docs([(1, "a\nb"), (2, "c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
