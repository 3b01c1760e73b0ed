import random

import pytest
import xxhash
from pyspark.sql import functions as F

from panelkit.llm import simhash
from panelkit.llm.components import components
from panelkit.llm.simhash import BKTree, fingerprint, near_duplicates, near_links, tree_links, without_near_duplicates


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 4 and group[j] > group[i]:
                    group[j], changed = group[i], True
    names = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            names[g] = min(names.get(g, i), i)
    return sorted(((i, f"{p:016x}", names.get(g)) for (i, _), p, g in zip(rows, prints, group)), key=str)


def texts(rng):
    base = [" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(90)) for _ in range(12)]
    rows = []
    for i in range(90):
        words = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = "edit"
        rows.append((1000 - i, rng.choice([" ", "\n", "  "]).join(words)))
    return rows + [
        (1, None),
        (2, ""),
        (3, " \t"),
        (4, "one two"),
        (5, "ONE two"),
        (6, "one two"),
        (None, rows[0][1]),
        (None, "only null ids here"),
        (7, "one two"),
        (7, "one two")
    ]


def test_fingerprints(spark):
    for text in ("", "a", "A b\tc", "É é x Y z", "w " * 500, "the of the of the of"):
        assert fingerprint(text.encode()) == plain_fingerprint(text)
    (row,) = spark.sql("SELECT xxhash64('the of and to') h").collect()
    assert row.h % 2**64 == xxhash.xxh64_intdigest(b"the of and to", 42)


@pytest.mark.parametrize("shard", [4096, 3])
def test_as_brute_force(docs, monkeypatch, shard):
    monkeypatch.setattr(simhash, "TREE", shard)
    rows = texts(random.Random(5))
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(docs(rows)).collect()), key=str)
    assert got == brute(rows)


def test_trees_find_all_within_the_radius():
    rng = random.Random(1)
    values = list({rng.getrandbits(12) for _ in range(300)})
    tree = BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 4096, 37):
        assert sorted(tree.near(q, 2)) == sorted(v for v in values if (v ^ q).bit_count() <= 2)
    assert len(tree_links(values, None, 2)) < len(values)


@pytest.mark.parametrize("blocks", [5, None, 8])
def test_links_join_all_pairs_for_any_number_of_blocks(spark, blocks):
    rng = random.Random(blocks or 6)
    seed = [rng.getrandbits(64) for _ in range(20)]
    values = sorted(
        {
            s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for s in seed for _ in range(8)
        } | {0, 2**64 - 1}
    )
    signed = [v - 2**64 if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    root = {r.node: r.root for r in components(near_links(df, blocks=blocks)).collect()}
    group = {v: v for v in signed}
    for _ in range(len(signed)):
        before = dict(group)
        for a, x in zip(values, signed):
            for b, y in zip(values, signed):
                if (a ^ b).bit_count() <= 4:
                    group[x] = group[y] = min(group[x], group[y])
        if before == group:
            break
    assert {v: root.get(v, v) for v in signed} == group


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 50)] + [(500, 400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 50)} | {400: 400, 500: 400}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_group_stays(docs):
    rows = [
        (3, "a b c d e"),
        (2, "a b c d e"),
        (9, "quite another text is here"),
        (4, None),
        (5, ""),
        (None, "a b c d e"),
        (None, "without an id")
    ]
    df = docs(rows)
    kept = without_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(2, "a b c d e"), (4, None), (9, "quite another text is here"), (None, "without an id")], key=str
    )
    assert without_near_duplicates(docs([])).count() == 0
    assert kept.select(F.max("n")).first()[0] == 1
