"""Every query against its SQL on the smallest driver tables, and what its plan may not contain."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def ordered(found):
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, str(TABLES))
    columns = sorted(df.columns)
    found = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert found
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in contract.oracle_sql():
        assert "Python" not in plan
        relation = oracle.sql(contract.oracle_sql()[name])
        assert sorted(relation.columns) == columns
        expected = relation.select(", ".join(f'"{c}"' for c in columns)).fetchall()
        assert ordered(found) == ordered(expected)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "revenue_growth_pct" in df.columns
