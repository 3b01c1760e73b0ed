from __future__ import annotations

from pathlib import Path

import pytest

from panelkit.llm.common import reach_workers

SF = "/root/testdata/sf0.001"
#: Columns that clash with names the operators use inside.
EXTRA = "_id string, id string, _text string, text_hash string, lang_pred string, dropped string, _kept string, row string, `n` int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text) or (id, text, lang), with further columns of clashing names."""

    def make(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", len(r[1] or "")) for r in rows]
        if not extra:
            return spark.createDataFrame(full, DOCS)
        return spark.createDataFrame([(*r, *["x"] * 8, 1) for r in full], f"{DOCS}, {EXTRA}")

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """Rows of a driver table as dictionaries."""
    return lambda name: [r.asDict() for r in spark.read.parquet(str(Path(SF) / f"{name}.parquet")).collect()]
