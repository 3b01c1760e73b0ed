import random
from collections import Counter

from panelkit.llm.line_dedup import DOCUMENTS, FIELD_DOCUMENTS, FIELD_SHARE, LEAST_TOKENS, templates, tokens, without_recurring_lines


def brute(rows):
    """Templates by the number of distinct texts that have them: copies of a text count once. More are asked for where a field varies."""
    seen = Counter()
    for text in {text or "" for _, text in rows}:
        seen.update(
            {t for line in text.split("\n") if len(tokens(line)) >= LEAST_TOKENS for t in templates(tokens(line))}
        )
    field = max(FIELD_DOCUMENTS, FIELD_SHARE * len({text or "" for _, text in rows}))

    def recurs(line):
        own = templates(tokens(line))
        return len(tokens(line)) >= LEAST_TOKENS and any(seen[t] >= (field if k else DOCUMENTS) for k, t in enumerate(own))

    found = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [recurs(x) for x in lines]
        found.append((i, text if text is None else "\n".join(x for x, g in zip(lines, gone) if not g), sum(gone)))
    return sorted(found, key=str)


def result(df):
    return sorted(((r.doc_id, r.text, r.lines_gone) for r in df.collect()), key=str)


def test_templates():
    assert tokens("Page 3 of 10 at http://x.y a@b") == ["Page", "<*>", "of", "<*>", "at", "<*>", "<*>"]
    made = templates("a b c d e f g".split())
    assert len(made) == 6 and made[0] == "\x00".join("abcdefg") and "\x00".join("ab") + "\x00<*>\x00d\x00e\x00f\x00g" in made
    assert templates("a b c d".split()) == ["\x00".join("abcd")]


def test_as_brute_force(docs):
    rng = random.Random(3)
    own = lambda: " ".join(
        "".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(rng.randint(1, 12))
    )
    rows = []
    for i in range(60):
        lines = [own() for _ in range(rng.randint(1, 6))]
        for line in (
            "All rights reserved by us.",
            f"Page {i} of our long report here",
            f"Posted by {own()[:4]} on our good old site today",
            "Ok.",
            ""
        ):
            if rng.random() < 0.4:
                lines.insert(rng.randint(0, len(lines)), line)
        rows.append((i, "\n".join(lines)))
    rows += [(100 + i, rows[3][1]) for i in range(6)] + [
        (200, None),
        (201, ""),
        (202, "\n\n"),
        (None, rows[5][1]),
        (7, rows[8][1]),
        (7, rows[8][1]),
        (203, rows[0][1] + "\n" + own() * 20_000)
    ]
    df = docs(rows)
    got = without_recurring_lines(df, count="lines_gone")
    assert got.columns == [*df.columns, "lines_gone"]
    assert result(got) == brute(rows)
    assert sum(r[2] for r in brute(rows)) > 30
    assert without_recurring_lines(df).columns == df.columns


def test_driver_documents(docs, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample("documents")]
    assert result(without_recurring_lines(docs(rows), count="lines_gone")) == brute(rows)


def test_empty_table(docs):
    assert without_recurring_lines(docs([])).count() == 0
