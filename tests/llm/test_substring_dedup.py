import random
from collections import defaultdict

import numpy as np
import pytest

from panelkit.llm import substring_dedup
from panelkit.llm.substring_dedup import WINDOW, _leftmost_minima, suffix_sorted, without_repeats


def brute(rows):
    texts, at = [(t or "").encode() for _, t in rows], defaultdict(list)
    for i, text in enumerate(texts):
        for p in range(len(text) - WINDOW + 1):
            at[text[p : p + WINDOW]].append((i, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in at.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p : p + WINDOW] = True
    found = []
    for (i, _), text, g in zip(rows, texts, gone):
        runs = int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum())
        found.append((i, len(text), int(g.sum()), runs, np.frombuffer(text, np.uint8)[~g].tobytes()))
    return sorted(found, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    some = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passages = [some(k) for k in (190, 200, 201, 230, 260, 320, 420, 700)]
    found = []
    for i in range(120):
        text = some(rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            text += p[rng.randint(0, 40) : len(p) - rng.randint(0, 40)] + some(rng.randint(0, 120))
        found.append((i, text))
    return found + [
        (200, "a" * 900),
        (201, "ab" * 400),
        (202, None),
        (203, ""),
        (204, found[3][1]),
        (204, found[3][1]),
        (None, found[5][1]),
        (205, "a" * 210),
        (3, found[9][1])
    ]


@pytest.mark.parametrize("together", [2048, 3])
def test_as_brute_force_by_sorting_and_by_digests(docs, rows, monkeypatch, together):
    monkeypatch.setattr(substring_dedup, "SORTED_TOGETHER", together)
    assert result(without_repeats(docs(rows))) == brute(rows)


def test_long_texts_are_read_in_blocks():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 105, 5000).astype(np.uint8).tobytes()
    whole = substring_dedup.contexts_of(text)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(whole[1], whole[2])])
    assert covered.tolist() == list(range(5000 - WINDOW + 1))


def test_minima_and_suffix_order():
    rng = random.Random(1)
    for _ in range(100):
        n = rng.randint(3, 60)
        width, values = rng.randint(1, min(n, 9)), np.array([rng.randint(0, 5) for _ in range(n)], np.uint64)
        assert _leftmost_minima(values, width).tolist() == [
            p + int(np.argmin(values[p : p + width])) for p in range(n - width + 1)
        ]
        symbols = np.array([[rng.randint(0, 2) for _ in range(12)] for _ in range(n)], np.uint16)
        group = np.sort([rng.randint(0, 3) for _ in range(n)])
        order, common = suffix_sorted(symbols, group)
        ordered = [(group[i], *symbols[i].tolist()) for i in order]
        assert ordered == sorted(ordered)
        for k in range(1, n):
            same = next((x for x in range(12) if ordered[k][x + 1] != ordered[k - 1][x + 1]), 12)
            assert common[k] == (same if ordered[k][0] == ordered[k - 1][0] else -1)


def test_a_collision_of_hashes_does_no_harm(monkeypatch):
    monkeypatch.setattr(substring_dedup, "_powers", lambda base, n: np.zeros(n, np.uint64))  # all hashes equal
    symbols = np.array([[3, 1], [1, 2], [2, 2], [1, 1]], np.uint16)
    order, common = suffix_sorted(symbols, np.zeros(4, np.int64))
    assert order.tolist() == [3, 1, 2, 0] and common.tolist() == [-1, 1, 0, 0]


def test_empty_table(docs):
    assert without_repeats(docs([])).count() == 0
