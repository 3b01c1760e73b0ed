import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelkit.llm import packing
from panelkit.llm.packing import best_fit, packed_documents, plan_sequences, reduce_by_dominance
from panelkit.llm.word_ids import word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def best(items, capacity):
    """Fewest sequences, by trying all."""
    items, found = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= found[0]:
            return
        if i == len(items):
            found[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            rooms[k] -= items[i]
            go(i + 1, rooms)
            rooms[k] += items[i]
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return found[0]


def one_by_one(items, capacity):
    rooms = []
    for size in sorted(items, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= size]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= size
        else:
            rooms.append(capacity - size)
    return len(rooms)


def test_reduction_keeps_a_best_packing_and_best_fit_is_best_fit():
    rng = random.Random(1)
    for _ in range(400):
        capacity = rng.choice([10, 20, 50])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        counts = np.bincount(items, minlength=capacity + 1) if items else np.zeros(capacity + 1, int)
        fixed, left = reduce_by_dominance(counts, capacity)
        rest = [s for s in range(capacity + 1) for _ in range(left[s])]
        assert sum(n for _, n in fixed) + best(rest, capacity) == best(items, capacity)
        assert sum(n for _, n in best_fit(counts, capacity)) == one_by_one(items, capacity)
        plan = plan_sequences(counts, capacity)
        assert all(sum(c) <= capacity for c, _ in plan)
        used = sum((n * np.bincount(c, minlength=capacity + 1) for c, n in plan), np.zeros(capacity + 1, int))
        assert (used == counts).all()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \t\n\x1c\x85\xa0　​AbcdZİΣ́é'stréll0١²ªµ×!.,;<|>ßﬁ\U0001d400漢\x00❤", max_size=40))
def test_word_ids_are_those_of_whole_texts(text):
    words = word_ids(PATH)
    for each in (text, text[:9] + "<|endoftext|>" + text[9:]):
        assert np.frombuffer(words.encode(each), "<u4").tolist() == Tokenizer.from_file(PATH).encode(
            each, add_special_tokens=False
        ).ids


def check(rows, found, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    by_row = {}
    for r in found:
        by_row.setdefault(r.doc_id, []).append(r)
    wanted = {}
    for i, text in rows:
        wanted.setdefault(i, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    assert set(by_row) == set(wanted)
    for i, documents in wanted.items():
        pieces = sorted(
            (
                k // capacity,
                k,
                len(ids[k : k + capacity]),
                zlib.crc32(np.array(ids[k : k + capacity], "<u4").tobytes())
            ) for ids in documents for k in range(0, len(ids), capacity)
        )
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_row[i]) == pieces
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    return sequences


def test_packed_documents(docs, sample, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 7)
    rows = [(r["doc_id"], r["text"]) for r in sample("documents")]
    rows += [
        (10**6, None),
        (10**6 + 1, ""),
        (10**6 + 2, "word " * 3000),
        (5, "again"),
        (5, "again"),
        (None, "no id"),
        (2**60 + 1, "big id")
    ]
    sequences = check(rows, packed_documents(docs(rows), PATH, 512).collect(), 512)
    tokens = sum(n for places in sequences.values() for _, n in places)
    assert len(sequences) <= 1.05 * -(-tokens // 512) + 1


def test_empty_table(docs):
    assert packed_documents(docs([]), PATH).count() == 0
