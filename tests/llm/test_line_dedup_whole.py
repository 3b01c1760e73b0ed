"""Lines that recur among distinct texts go from every document, and only those."""

from panelkit.llm.line_dedup import templates, tokens, without_recurring_lines

WORDS = "amber birch cedar delta ember frost grove hazel inlet jetty knoll lemon".split()


def own(i):
    """A line that no other number has."""
    return " ".join(WORDS[(i * (k + 1) + k) % 12] + "abcdefghij"[i // 10 % 10] + "klmnopqrst"[i % 10] for k in range(8))


def texts(docs, rows):
    return {r.doc_id: r.text for r in without_recurring_lines(docs(rows)).collect()}


def test_lines_that_make_up_most_of_a_document_go(docs):
    line = "All rights to this text are reserved by us"
    rows = [(i, f"{own(i)}\n{line}") for i in range(5)] + [(10, f"Short text here.\n{line}"), (11, f"{line}\n{line}")]
    got = texts(docs, rows)
    assert got == {i: own(i) for i in range(5)} | {10: "Short text here.", 11: ""}


def test_copies_count_once(docs):
    copy = f"{own(50)}\n{own(51)}"
    line = "All rights to this text are reserved by us"
    rows = [(i, copy) for i in range(7)] + [(10 + i, f"{own(i)}\n{line}") for i in range(4)]
    rows += [(20 + i, f"{own(60)}\n{line}") for i in range(6)]
    got = texts(docs, rows)
    assert all(got[i] == copy for i in range(7))
    assert [got[10 + i] for i in range(4)] == [own(i) for i in range(4)] and got[20] == got[25] == own(60)


def test_lines_of_one_or_two_tokens(docs):
    passage = "这是一段在许多文件里重复出现的文字，没有空格，但是很长。"
    rows = [(i, f"{own(i)}\n{passage}\nRead more\n\nSubscribe") for i in range(5)] + [(9, f"{passage}\nonce only\nrare")]
    assert texts(docs, rows) == {i: f"{own(i)}\n" for i in range(5)} | {9: "once only\nrare"}


def test_rows_of_numbers_are_told_apart(docs):
    rows = [(i, f"{own(i)}\n{i} {i + 3} {i * 7} 9 {i * i}\n2024-01-{i + 10}\nBerlin {i} {i}\nPage {i} of our report") for i in range(6)]
    got = texts(docs, rows)
    assert got == {i: "\n".join(text.split("\n")[:4]) for i, text in rows}
    same = [(i, f"{own(i)}\n1 2 3 4 5") for i in range(5)]
    assert texts(docs, same) == {i: own(i) for i in range(5)}


def test_every_template_keeps_constant_tokens():
    assert templates(tokens("12 34 5 6 78")) == ["\x00".join(["12", "34", "5", "6", "78"])]
    for line in ("Row a 1 2 3 b", "a 1 b 2 c", "a b 1 2 3 c d"):
        for t in templates(tokens(line)):
            kept = [x for part in t.split("\x00") for x in part.replace("<*>", " ").split()]
            assert len(kept) >= 2


def test_lines_that_say_different_things_stay(docs):
    cities = "Paris Rome Oslo Bern Lima Riga".split()
    rows = [(i, f"{own(i)}\nThe capital of this country is {city}") for i, city in enumerate(cities)]
    assert texts(docs, rows) == dict(rows)


def test_a_field_that_differs_in_many_documents(docs):
    rows = [(i, f"{own(i)}\nPosted by {own(i + 40).split()[0]} on our good old site today") for i in range(20)]
    assert texts(docs, rows) == {i: own(i) for i, _ in rows}
    assert texts(docs, rows[:19]) == dict(rows[:19])
