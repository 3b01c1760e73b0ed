"""Ranked search against brute force over plain dictionaries."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelkit.llm import ranked_search
from panelkit.llm.ranked_search import _term_tiles, ranked, terms

PART = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return PART.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(documents, items, most=50):
    counted = [(i, Counter(plain_terms(t))) for i, t in documents]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n, total = len(counted), sum(k for _, _, k in counted)
    having = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(plain_terms(t))
    found = []
    for item, wanted in asked.items():
        scores = []
        for i, c, k in counted:
            m = 50 + (50 * k * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * having[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in wanted if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        found += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:most])]
    return sorted(found, key=str)


def result(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", "x") for r in rows], "item_id long, text string, id string, terms string")


def test_terms():
    for text in ("Foo-bar1 ÄÖ x_y É z 漢字, a\tb\x00c", "", "...", "ÀB C"):
        assert [t.decode() for t in terms(text.encode())] == plain_terms(text)


def make(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_as_brute_force(docs, items, monkeypatch):
    for name, size in (("ITEM_TILE", 3), ("TERM_TILE", 7), ("DOCUMENT_TILE", 5), ("HELD", 4)):
        monkeypatch.setattr(ranked_search, name, size)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["Ümlaut", "漢字", "rare", "THE", "the"]
    rows = [(i, make(rng, words, rng.randint(1, 30))) for i in range(150)]
    rows += [(1000 - i, rows[0][1]) for i in range(80)]  # ties beyond the limit
    rows += [(None, rows[0][1]), (None, None), (2000, ""), (2001, "-- !"), (2002, None), (7, rows[8][1]), (7, rows[8][1])]
    rows += [(3000, make(rng, words, 20_000))]
    asked = [(i, make(rng, words, rng.randint(1, 12))) for i in range(10)]
    asked += [(20, None), (21, ""), (22, "nowhere"), (3, "rare W1"), (None, "w2 w3"), (23, rows[0][1])]
    found = result(ranked(docs(rows), items(asked)))
    assert found == brute(rows, asked)
    tied = [r[2] for r in sorted((r for r in found if r[0] == 23), key=lambda r: r[1])]
    assert 0 in tied and tied[-40:] == list(range(tied[-40], tied[-40] + 40)) and tied[-1] < 1000


def test_blocks_of_items(docs, items, monkeypatch):
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 600)
    rng = random.Random(6)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, make(rng, words, 15)) for i in range(80)]
    asked = [(i, make(rng, words, 8)) for i in range(9)]
    assert result(ranked(docs(rows), items(asked), most=3)) == brute(rows, asked, 3)


def test_text_ids(spark):
    documents = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    asked = spark.createDataFrame([("q-1", "x")], "item_id string, text string")
    assert [r.doc_id for r in ranked(documents, asked).orderBy("rank").collect()] == ["a", "b", None]


def test_sums_stay_exact():
    assert _term_tiles(np.array([1 << 52, 1 << 52, 5, (1 << 53) - 6, 9])) == [(0, 1), (1, 3), (3, 4), (4, 5)]
    assert _term_tiles(np.array([], np.int64)) == []


def test_empty_tables(docs, items):
    assert ranked(docs([]), items([(1, "a")])).collect() == []
    assert ranked(docs([(1, "a")]), items([])).collect() == []
    assert ranked(docs([(1, None)]), items([(1, "a")])).collect() == []
    assert ranked(docs([(1, "a")]), items([])).columns == ["item_id", "rank", "doc_id", "score"]
