"""Removal of near-duplicates against brute force over exact shingle similarities."""

import random

from panelkit.llm import simhash
from panelkit.llm.simhash import without_near_duplicates


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    near = [
        [j for j, b in enumerate(sets) if a == b or a and len(a & b) >= 0.8 * len(a | b)] for a in sets
    ]
    before = None
    while before != group:
        before = list(group)
        group = [min(group[j] for j in n) for n in near]
    names = {}
    for g, (i, _) in zip(group, rows):
        names[g] = min(names.get(g, i), i)
    return sorted(i for g, (i, _) in zip(group, rows) if names[g] == i)


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = "".join(rng.choice("xyz") for _ in range(9))
    return " ".join(words)


def test_pairs_of_low_similarity_go(docs):
    """Copies at a similarity of 0.8 to 0.9, most of which differ in more than 4 of 64 bits; others below stay."""
    rng = random.Random(8)
    own = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    rows = []
    for i in range(60):
        text = own(rng.randint(60, 400))
        edits = len(text.split(" ")) * rng.choice([1, 2, 4]) // 100
        rows += [(2 * i, text), (2 * i + 1, edited(rng, text, edits))]
    prints = [simhash.fingerprint(t.encode()) for _, t in rows]
    assert sum((a ^ b).bit_count() > 4 for a, b in zip(prints[::2], prints[1::2])) > 15
    kept = sorted(r.doc_id for r in without_near_duplicates(docs(rows)).collect())
    assert kept == brute(rows) and 60 < len(kept) < 100


def test_a_large_group_in_shards(docs, monkeypatch):
    """A group whose members are near each other, but not all at the least similarity: chains join it."""
    monkeypatch.setattr(simhash, "TREE", 7)
    rng = random.Random(9)
    base = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(150))
    rows = [(i, edited(rng, base, rng.randint(0, 5))) for i in range(60)]
    assert sorted(r.doc_id for r in without_near_duplicates(docs(rows)).collect()) == brute(rows)
