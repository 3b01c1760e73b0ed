import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from panelkit.llm.exact_dedup import exact_duplicates

ROWS = [
    (5, "a  b"), (3, "a\t\nb"), (9, "a b"), (1, None), (2, ""), (4, " "), (6, "a b"), (7, "x" * 300_000), (8, "x" * 300_000),
    (10, "A b"), (None, "a b"), (None, "alone"), (3, "a\t\nb"), (11, "unique"),
]


def brute(rows):
    groups = defaultdict(list)
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    for (i, _), t in zip(rows, normal):
        groups[t].append(i)
    found = []
    for (i, _), t in zip(rows, normal):
        keep = min((x for x in groups[t] if x is not None), default=None)
        found.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(found, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_as_brute_force(docs):
    assert result(exact_duplicates(docs(ROWS))) == brute(ROWS)


def test_colliding_hashes_are_told_apart_by_bytes(docs):
    weak = lambda c: F.md5(F.substring(c, 1, 1))
    assert result(exact_duplicates(docs(ROWS), hashed=weak)) == brute(ROWS)


def test_empty_table_and_schema(docs):
    found = exact_duplicates(docs([]))
    assert found.count() == 0
    assert found.dtypes == [
        ("doc_id", "bigint"),
        ("keep_id", "bigint"),
        ("group_size", "bigint"),
        ("kept", "boolean"),
        ("text_sha256", "string")
    ]


def test_no_python_in_the_plan(docs):
    plan = exact_duplicates(docs(ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
