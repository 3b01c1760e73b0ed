from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from panelkit.llm import language
from panelkit.llm.language import Model, best_path, fit, held_out, identify, predicted_languages, recognised, words_of


def test_best_path_as_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        length = rng.integers(1, 6, 4)
        first = np.cumsum(length) - length
        scores = rng.normal(0, rng.choice([1, 3, 9]), (length.sum(), 3)).astype(np.float32)
        path = best_path(scores, first, length, 2.0)
        for a, n in zip(first, length):
            worth = lambda p: sum(
                scores[a + i, x] for i, x in enumerate(p)
            ) - 2 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: B023, E731
            assert worth(path[a : a + n]) == pytest.approx(max(map(worth, product(range(3), repeat=int(n)))), abs=1e-4)


def test_words_are_runs_of_letters():
    words = words_of(["Ab c1d", "", "é-ж"])
    assert list(
        zip(words.text.tolist(), words.start.tolist(), words.end.tolist())
    ) == [(0, 0, 2), (0, 3, 4), (0, 5, 6), (2, 0, 1), (2, 2, 3)]
    assert words_of(["ABC"]).cells.tolist() == words_of(["abc"]).cells.tolist()


@pytest.fixture(scope="module")
def model(docs):
    rows = [
        (i, t, lang) for i,
        (t, lang) in enumerate(
            [
                ("the cat and the dog are here", "en"),
                ("le chat et le chien sont ici", "fr"),
                ("кот и собака здесь", "ru")
            ] * 20
        )
    ]
    return fit(docs(rows))


def test_scripts_narrow_the_candidates(docs, model):
    got = {r.doc_id: r for r in identify(docs([(1, "щёю"), (2, "the dog"), (3, "日本語")]), model).collect()}
    assert got[1].lang_pred == "ru" and got[1].score == 1.0
    assert got[2].lang_pred == "en"
    assert got[3].lang_pred in model.languages  # no language has the script: all stay candidates


def test_spans_of_mixed_text(docs, model):
    text = "the cat and the dog are here. кот и собака здесь. le chat et le chien sont ici"
    (row,) = identify(docs([(1, text)]), model).collect()
    assert [(text[s.start : s.end], s.lang) for s in row.spans] == [
        ("the cat and the dog are here", "en"), ("кот и собака здесь", "ru"), ("le chat et le chien sont ici", "fr"),
    ]
    letters = {lang: sum(c.isalpha() for c in text[s.start : s.end]) for s in row.spans for lang in [s.lang]}
    assert row.score == pytest.approx(max(letters.values()) / sum(letters.values()))


def test_without_letters_or_model(docs, model):
    rows = [(1, None), (2, ""), (3, "12 !? ٣"), (None, "the dog"), (4, "the dog"), (4, "the dog")]
    got = [(r.doc_id, r.lang_pred, r.score) for r in identify(docs(rows), model).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (None, "en", 1.0), (4, "en", 1.0), (4, "en", 1.0)], key=str
    )
    nothing = fit(docs([(1, None, "en"), (2, "x", None)]))
    assert nothing.languages == ()
    assert [r.lang_pred for r in identify(docs([(1, "the")]), nothing).collect()] == ["und"]
    assert identify(docs([]), model).count() == 0


def test_long_text_and_parts(docs, model, monkeypatch):
    text = "the cat and the dog are here " * 20_000
    whole = identify(docs([(1, text), (2, "le chien")]), model).collect()
    monkeypatch.setattr(language, "SCORED", 10)
    found = language.label(pa.array([text, "le chien"]), model)
    assert [r.lang_pred for r in whole] == [model.languages[i] for i in found.language] == ["en", "fr"]
    assert [len(r.spans) for r in whole] == [1, 1]


def test_recognised_keeps_rows_and_columns(docs, model):
    df = docs([(1, "the cat"), (2, "123"), (3, None)])
    kept = recognised(df, model)
    assert kept.columns == df.columns
    assert [r.doc_id for r in kept.collect()] == [1]


def test_lang_is_no_input_of_the_prediction(spark, docs, sample):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in sample("documents")]
    blind = [(i, t, None if i % 2 else lang) for i, t, lang in rows]
    df = docs(rows)
    model = fit(df.filter(~held_out()))
    both = [sorted((r.doc_id, r.lang_pred, r.score) for r in identify(docs(x), model).collect()) for x in (rows, blind)]
    assert both[0] == both[1]


def test_held_out_accuracy(docs, sample):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in sample("documents")]
    truth = {i: lang for i, _, lang in rows}
    tested = [r for r in predicted_languages(docs(rows)).collect() if r.held_out and truth[r.doc_id] is not None]
    assert len(tested) > 20
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in tested]) >= 0.95


def test_model_is_a_plain_value():
    assert Model(("a",), np.zeros((1, 1)), np.ones((1, 1), bool)).languages == ("a",)


def test_samples_are_bounded_and_alike_for_any_split(spark):
    from panelkit.llm.common import sampled

    df = spark.range(5000).selectExpr("id", "IF(id % 10 = 0, 'a', 'b') AS lang")
    one, many = (
        sampled(
            df.repartition(n), 50, "id", "lang"
        ).groupBy("lang").agg({"id": "sum", "*": "count"}).collect() for n in (1, 40)
    )
    assert sorted(one) == sorted(many) and {r.lang: r["count(1)"] for r in one} == {"a": 50, "b": 50}
    assert sampled(df, 10**6, "id", "lang").count() == 5000
    assert sampled(df, 20, "id").count() == 20 and sampled(df.limit(0), 20, "id").count() == 0
