import random

import pytest

from panelkit.llm import decontamination
from panelkit.llm.decontamination import contaminated, decontaminated, tiles, words


def plain_tiles(item, text, least):
    """Greedy string tiling by looking at all pairs of places again after each tile."""
    free_item, free_text, found = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(text)):
                n = 0
                while a + n < len(item) and b + n < len(text) and text[b + n] and item[a + n] == text[b + n] and free_item[a + n] and free_text[b + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return found
        free_item[a : a + n] = free_text[b : b + n] = [False] * n
        found.append((a, b, n))


def test_tiles_as_brute_force():
    rng = random.Random(2)
    for _ in range(500):
        kinds = rng.choice([2, 3, 6])
        item = [rng.randint(1, kinds) for _ in range(rng.randint(0, 22))]
        text = [rng.randint(0, kinds) for _ in range(rng.randint(0, 25))]
        if rng.random() < 0.5 and len(item) > 6:
            cut = rng.randint(2, len(item) - 2)
            text = text[:9] + item[cut:] + text[9:15] + item[:cut]
        least = rng.choice([2, 3, 5])
        assert tiles(item, text, least) == plain_tiles(item, text, least)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
PARTS = ITEM.split()
ROWS = [
    (1, f"before {ITEM} after"), (
        2, "before " + " ".join(PARTS[8:]) + " between " + " ".join(PARTS[:8]) + " after"
    ), (3, " ".join(PARTS[:7])),
    (4, None), (5, ""), (
        6, ITEM.upper().replace(" ", ", ")
    ), (7, "nothing of it " * 5000 + ITEM), (8, " x ".join(PARTS)), (None, ITEM), (1, f"before {ITEM} after"),
    (9, "one two three four five six"), (10, " ".join(PARTS[:6]) + " edit " + " ".join(PARTS[7:])),
]
BENCH = [
    (7, ITEM),
    (3, "one two three four five six"),
    (5, "too few words"),
    (6, None),
    (8, ITEM),
    (None, "some other item of words here")
]


def bench(spark, rows=BENCH):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, id string")


def brute(rows, items):
    found = []
    for i, text in rows:
        numbers, best = {}, (0.0, None)
        for item_id, item in items:
            own = [numbers.setdefault(w, len(numbers) + 1) for w in words(item)]
            if len(own) >= 5:
                got = [numbers.get(w, 0) for w in words(text)]
                if len(got) < 500:
                    share = sum(n for _, _, n in plain_tiles(own, got, 5)) / len(own)
                else:
                    share = float(item == ITEM)
                if share and (share > best[0] or share == best[0] and item_id is not None and item_id < best[1]):
                    best = (share, item_id)
        found.append((i, best[0] >= 0.8, best[1], round(best[0], 9)))
    return sorted(found, key=str)


@pytest.mark.parametrize("size", [16 << 20, 60])
def test_as_brute_force_in_one_block_and_in_many(spark, docs, monkeypatch, size):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", size)
    got = sorted(
        ((r.doc_id, r.contaminated, r.item_id, round(r.coverage, 9)) for r in contaminated(docs(ROWS), bench(spark)).collect()),
        key=str
    )
    assert got == brute(ROWS, [b for b in BENCH if b[0] is not None])
    kept = decontaminated(docs(ROWS), bench(spark))
    assert kept.columns == docs(ROWS).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in got if not r[1]), key=str)


def test_reordered_passages_and_tiles(spark, docs):
    got = {r.doc_id: r for r in contaminated(docs(ROWS[:3]), bench(spark)).collect()}
    assert got[2].contaminated and got[2].coverage == 1.0
    assert [(t.item_start, t.doc_start, t.length) for t in got[2].tiles if t.item_id == 7] == [(0, 9, 8), (8, 1, 7)]
    assert not got[3].contaminated and got[3].coverage == pytest.approx(7 / 15)


def test_empty_tables(spark, docs):
    assert contaminated(docs([]), bench(spark)).count() == 0
    assert [r.contaminated for r in contaminated(docs([(1, ITEM)]), bench(spark, [])).collect()] == [False]
    assert decontaminated(docs([(1, ITEM)]), bench(spark, [])).count() == 1


def test_planted_passages_are_found_and_others_left_alone(spark, docs, sample):
    items = [(r["item_id"], r["text"]) for r in sample("benchmark")]
    rows = [(r["doc_id"], r["text"]) for r in sample("documents")]
    flat = {i: " ".join(words(t)) for i, t in rows}
    holds = {i for i, t in flat.items() if any(" ".join(words(b)) in t for _, b in items)}
    got = {r.doc_id for r in contaminated(docs(rows), bench(spark, items)).collect() if r.contaminated}
    assert holds and got == holds
