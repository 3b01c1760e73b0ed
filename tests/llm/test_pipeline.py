import numpy as np
import pytest

import corpus_pipeline
from tests.llm import plain


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave, on the driver's smallest tables with a few odd rows."""
    from panelkit.sources.tables import checkpointed

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [
        (10**6, None, None, None, None),
        (10**6 + 1, "", "en", "s", 0),
        (10**6 + 2, "123 !", None, "s", 5),
        (10**6 + 3, docs.first().text, "en", "s", 9)
    ]
    docs, seen = checkpointed(docs.union(spark.createDataFrame(odd, docs.schema))), []
    for name, stage in corpus_pipeline.STAGES:
        made = checkpointed(stage(spark, docs, sf_dir))
        seen.append((name, docs, made))
        docs = made
    return sf_dir, seen


def test_stages_and_columns(stages):
    _, seen = stages
    assert [name for name, _, _ in seen] == ["language", "lines", "near_duplicates", "decontamination", "packing"]
    for _, before, after in seen[:-1]:
        assert after.dtypes == before.dtypes


@pytest.mark.parametrize("number", range(5))
def test_stage_as_plain_python(stages, spark, number):
    sf_dir, seen = stages
    name, before, after = seen[number]
    rows = [r.asDict() for r in before.collect()]
    got = [r.asDict() for r in after.collect()]
    if name == "packing":
        assert plain.pieces(rows) == sorted(
            (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got
        )
        fill = np.bincount([r["sequence_id"] for r in got], weights=[r["length"] for r in got])
        assert fill.max() <= 4096 and fill.min() > 0
        return
    benchmark = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    wanted = getattr(plain, name)(rows, benchmark)
    key = lambda r: str(sorted(r.items()))
    assert sorted(got, key=key) == sorted(wanted, key=key)
    assert 0 < len(got) <= len(rows)


def test_run_applies_the_stages(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 100
