"""Items without an id, with ids of text, and of one word."""

from panelkit.llm.decontamination import contaminated, decontaminated

LONG = "one two three four five six seven eight nine ten"


def found(df):
    return {r.doc_id: (r.contaminated, r.item_id, r.coverage) for r in df.collect()}


def test_items_without_an_id_count(spark, docs):
    bench = spark.createDataFrame([(None, LONG), (4, "other words that are not in any of the texts")], "item_id long, text string")
    rows = [(1, f"before {LONG} after"), (2, "clean"), (3, None)]
    assert found(contaminated(docs(rows), bench)) == {1: (True, None, 1.0), 2: (False, None, 0.0), 3: (False, None, 0.0)}
    assert sorted(r.doc_id for r in decontaminated(docs(rows), bench).collect()) == [2, 3]
    both = spark.createDataFrame([(None, LONG), (7, LONG), (9, LONG)], "item_id long, text string")
    assert found(contaminated(docs(rows), both))[1] == (True, 7, 1.0)


def test_ids_of_text(spark, docs):
    bench = spark.createDataFrame([("q-2", LONG), ("q-1", LONG), (None, "x")], "item_id string, text string")
    got = contaminated(docs([(1, LONG), (2, "y")]), bench)
    assert found(got) == {1: (True, "q-1", 1.0), 2: (False, None, 0.0)}
    assert {t.item_id for t in got.filter("doc_id = 1").first().tiles} == {"q-1", "q-2"}


def test_one_word_does_not_contaminate(spark, docs):
    bench = spark.createDataFrame([(1, "Yes"), (2, "Oh no!")], "item_id long, text string")
    rows = [(1, "yes it is"), (2, "oh no it is not"), (3, "no")]
    got = contaminated(docs(rows), bench)
    assert found(got) == {1: (False, None, 0.0), 2: (True, 2, 1.0), 3: (False, None, 0.0)}
    assert [t.item_id for t in got.filter("doc_id = 1").first().tiles] == [1]
    assert sorted(r.doc_id for r in decontaminated(docs(rows), bench).collect()) == [1, 3]
