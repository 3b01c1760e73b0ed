from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("panelkit-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from panelkit.sources import TableStore

    return TableStore(spark, str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def frame(spark):
    """Build a frame from rows and a DDL schema."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (NULLs first)."""
    found = df.orderBy(*order).collect() if order else df.collect()
    return [tuple(r) for r in found]
