"""Whitening against the eigenvectors of the covariance as a whole."""

import math
import random

import numpy as np
import pytest

from panelkit.llm import whitening
from panelkit.llm.whitening import whitened

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x string, ids int"


@pytest.fixture
def vectors(spark):
    return lambda rows, schema=SCHEMA: spark.createDataFrame([(i, v, 1, "a", "b", 2) for i, v in rows], schema)


def usable(v):
    return v and all(c is not None and math.isfinite(c) for c in v)


def check(found, rows, most=8, tolerance=1e-9):
    """The result against numpy's eigenvectors; returns the result's rows by id and component."""
    rows = [(i, v) for i, v in rows if usable(v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows])
    n, s = len(x), x.sum(0)
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = [k for k in range(min(most, len(values))) if values[k] > 1e-14 * values.sum()]
    got = sorted(found.collect(), key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component))
    assert len(got) == len(kept) * n
    order = sorted(range(n), key=lambda r: (rows[r][0] is None, rows[r][0] or 0))
    exact = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(x[r], s)) for r in order]
    wanted = centred[order] @ vectors[:, kept] / np.sqrt(values[kept])
    matrix = np.array([r.whitened for r in got]).reshape(n, len(kept))
    for k in range(len(kept)):
        sign = np.sign(matrix[:, k] @ wanted[:, k])
        assert np.abs(matrix[:, k] - sign * wanted[:, k]).max() < tolerance
    assert [r.deviation for r in got[:: len(kept)]] == [e if e < 1 << 63 else None for e in exact]
    assert [r.component for r in got] == [k + 1 for k in kept] * n and {r.n for r in got} == {n}
    explained = np.array([r.explained for r in got[: len(kept)]])
    assert np.abs(explained / (values[kept] / values.sum()) - 1).max() < 1e-9
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-9
    return got


def test_as_eigenvectors(vectors):
    rng = np.random.default_rng(1)
    mix = rng.standard_normal((20, 20)) * np.linspace(1, 0.05, 20)
    rows = [(i, [float(c) for c in rng.standard_normal(20) @ mix / 10 + 0.3]) for i in range(700)]
    rows += [(None, rows[3][1]), (900, None), (901, []), (902, [None] * 20)]
    rows += [(903, [float("nan")] * 20), (904, [*rows[0][1][:-1], float("inf")]), (905, [*rows[0][1][:-1], None])]
    found = whitened(vectors(rows))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found, rows)


def test_driver_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(whitened(df), [(r.vec_id, list(r.embedding)) for r in df.collect()])


def test_fewer_directions_than_dimensions(vectors):
    rng = np.random.default_rng(2)
    half = [[float(c) for c in rng.integers(-64, 64, 3) / 64] for _ in range(90)]
    rows = [(i, [*v, v[0], 0.5, v[1] - v[2]]) for i, v in enumerate(half)]
    got = check(whitened(vectors(rows)), rows)
    assert {r.component for r in got} == {1, 2, 3}


def test_equal_eigenvalues(vectors):
    """Orthogonal directions of the same spread: any eigenvectors will do, but all of them have to come."""
    rows = [(2 * k + (s > 0), [s * (k == j) * 1.0 for j in range(4)]) for k in range(4) for s in (-1, 1)]
    got = whitened(vectors(rows)).collect()
    assert len(got) == 32 and got[0].identity_error < 1e-9 and {round(r.explained, 12) for r in got} == {0.25}


def test_end_by_residual(vectors, monkeypatch):
    """With more dimensions than steps asked for it ends once the wanted components are found."""
    monkeypatch.setattr(whitening, "LEAST_STEPS", 10)
    passes, reduced = [], whitening._reduced
    monkeypatch.setattr(whitening, "_reduced", lambda *a: passes.append(1) or reduced(*a))
    rng = np.random.default_rng(3)
    scales = np.concatenate([2.0 ** -np.arange(4), np.full(56, 1e-3)])
    rows = [(i, [float(c) for c in rng.standard_normal(60) * scales]) for i in range(300)]
    check(whitened(vectors(rows), most=4), rows, 4, 1e-6)
    assert len(passes) < 50


def test_large_entries(vectors):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1e6, 1e6), rng.uniform(-1, 1)]) for i in range(50)]
    check(whitened(vectors(rows)), rows, tolerance=1e-6)
    far = whitened(vectors([(1, [3e38, 1.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.5])])).collect()
    assert {r.deviation for r in far if r.vec_id == 1} == {None}


def test_repeated_rows(vectors):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 0.5]), (2, [0.25, 0.0]), (None, [0.0, 0.0]), (None, [0.5, 1.0])]
    got = whitened(vectors(rows)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows * 2)
    assert got[0].identity_error < 1e-9 and {r.n for r in got} == {6}


def test_deviations_are_exact_or_none():
    rng = np.random.default_rng(5)
    whole, n = rng.integers(-3000, 3000, (40, 16)), 10**6
    rest = [int(r) for r in rng.integers(0, n, 16)]
    wanted = [sum((int(c) * n - r) ** 2 for c, r in zip(row, rest)) for row in whole]
    assert max(wanted) >= 1 << 63
    small = whole // 50
    exact = [sum((int(c) * n - r) ** 2 for c, r in zip(row, rest)) for row in small]
    assert whitening._deviations(small, n, rest) == exact and max(exact) < 1 << 63
    assert whitening._deviations(whole, n, rest) == [w if w < 1 << 63 else None for w in wanted]


def test_other_lengths(vectors):
    rows = [(i, [i / 10, -i / 7]) for i in range(6)] + [(10, [1.0]), (11, [1.0, 2.0, 3.0])]
    got = whitened(vectors(rows)).collect()
    assert {r.vec_id for r in got} == set(range(6))


def test_no_rows(vectors):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = whitened(vectors(rows))
        assert found.collect() == [] and found.columns[0] == "vec_id"
