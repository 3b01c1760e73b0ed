import re

import duckdb
import pytest

import __spark_entry__ as contract
from panelkit.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SF


def test_all_are_registered():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    found = QUERIES[name](spark, SF)
    rows = [tuple(r[c] for c in sorted(found.columns)) for r in found.collect()]
    key = next(c for c in ("page_id", "item_id", "vec_id", "doc_id") if c in found.columns and (c != "item_id" or "rank" in found.columns))
    tables = {"page_id": "pages", "item_id": "benchmark", "vec_id": "embeddings", "doc_id": "documents"}
    source = spark.read.parquet(f"{SF}/{tables[key]}.parquet")
    assert {r[0] for r in found.select(key).collect()} == {r[0] for r in source.select(key).collect()}
    if name in ORACLES:
        base = duckdb.connect()
        for table in tables.values():
            base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        asked = base.execute(ORACLES[name])
        names = [d[0] for d in asked.description]
        wanted = [tuple(dict(zip(names, r))[c] for c in sorted(names)) for r in asked.fetchall()]
        assert sorted(names) == sorted(found.columns)
        assert sorted(rows, key=str) == sorted(wanted, key=str)
