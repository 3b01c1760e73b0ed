"""Items in scripts without spaces, and items shorter than a tile."""

from panelkit.llm.decontamination import Benchmark, contaminated, decontaminated, words

CHINESE = "请问世界上最高的山峰叫什么名字，它位于哪两个国家之间，海拔是多少"
ITEMS = [(1, CHINESE), (2, "Who wrote Hamlet?"), (3, None), (4, "?!")]


def test_words():
    assert words("Ab_c 山峰,x1か") == ["ab", "c", "山", "峰", "x1", "か"] and words("Été 한국어 text") == ["été", "한국어", "text"]


def test_short_and_unsegmented_items_are_found(spark, docs):
    rows = [
        (1, f"前言在此。{CHINESE}。后面还有别的内容"), (2, "They asked: who wrote Hamlet, and when"), (3, "Hamlet wrote who"),
        (4, "山峰很高"), (5, None), (6, "who wrote hamlet"),
    ]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r.doc_id: r for r in contaminated(docs(rows), bench).collect()}
    assert {i: (r.contaminated, r.item_id, r.coverage) for i, r in got.items()} == {
        1: (True, 1, 1.0), 2: (True, 2, 1.0), 3: (False, None, 0.0), 4: (False, None, 0.0), 5: (False, None, 0.0), 6: (True, 2, 1.0)
    }
    assert [(t.item_start, t.doc_start, t.length) for t in got[2].tiles] == [(0, 2, 3)]
    assert sorted(r.doc_id for r in decontaminated(docs(rows), bench).collect()) == [3, 4, 5]


def test_short_and_long_items_together():
    block = Benchmark([(9, "one two three four five six"), (5, "two three")])
    assert block.look("zero one two three four five six") == (5, 1.0, [(5, 0, 2, 2), (9, 0, 1, 6)])
