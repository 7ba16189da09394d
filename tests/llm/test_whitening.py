from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from parampipe.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, n string"


def table(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], v, 0, "x") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def exact_covariance(x):
    n, size = len(x), len(x[0])
    mean = [Fraction(sum(int(r[i]) for r in x), n) for i in range(size)]
    return [
        [sum((int(r[i]) - mean[i]) * (int(r[j]) - mean[j]) for r in x) / n for j in range(size)] for i in range(size)
    ]


def as_whole(vectors):
    return [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]


def drawn(seed, n, size):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, size)) @ draw.normal(size=(size, size))).astype(np.float32).tolist()


def collect(df, components=8):
    rows = whitening.whiten(df, "vec_id", "embedding", components).collect()
    return sorted(rows, key=lambda r: (r.id is None, r.id or 0, r.component))


def check(rows, vectors, components=8):
    """Against exact fractions and an eigendecomposition of their matrix."""
    x = as_whole(vectors)
    n, size = len(x), len(x[0])
    exact = exact_covariance(x)
    v = np.array([[float(c) for c in row] for row in exact])
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(components, size)
    assert len(rows) == n * k
    sums = [sum(r[i] for r in x) for i in range(size)]
    w = np.array([r.whitened for r in rows]).reshape(n, k)
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(r, sums)] for r in x])
    for c in range(k):
        # the axis behind the whitened values, from the values themselves
        assert np.isclose(w[:, c].var(), 1) and abs(w[:, c].mean()) < 1e-9
        axis = np.linalg.lstsq(centred, w[:, c] * math.sqrt(values[c]), rcond=None)[0]
        assert np.allclose(v @ axis, values[c] * axis, rtol=1e-7, atol=1e-7 * values[0])
        assert np.isclose(np.linalg.norm(axis), 1)
    for i, r in enumerate(rows):
        far = sum((n * a - s) ** 2 for a, s in zip(x[i // k], sums))
        assert (r.n, r.component, r.deviation) == (n, i % k + 1, far if far < 2**63 else None)
        assert math.isclose(r.explained, values[i % k] / v.trace(), rel_tol=1e-9)
        assert r.identity_error < 1e-9
    return w


def test_polarised_sums_give_the_exact_matrix(spark):
    vectors = drawn(3, 90, 7)
    frame = spark.createDataFrame([(v,) for v in vectors], "v array<double>").repartition(5)
    n, sums = whitening.dimension_sums(frame, 7)
    x = as_whole(vectors)
    assert (n, sums) == (90, [sum(r[i] for r in x) for i in range(7)])
    found = whitening.squared_sums(frame, 7, np.array([s // n for s in sums]))
    assert sorted(found) == sorted([(i, -1) for i in range(7)] + [(i, j) for i in range(7) for j in range(i, 7)])
    matrix = whitening.assemble(n, found, 7)
    assert matrix.tolist() == [[float(c) for c in row] for row in exact_covariance(x)]


@pytest.mark.parametrize("size", [3, 8, 20])
def test_against_fractions(spark, size):
    vectors = drawn(size, 120, size)
    check(collect(table(spark, vectors).repartition(6)), vectors)


def test_same_for_every_layout(spark):
    vectors = drawn(1, 60, 10)
    a, b = (collect(table(spark, vectors).repartition(p)) for p in (1, 7))
    assert [(r.id, r.component, r.deviation, r.explained) for r in a] == [(r.id, r.component, r.deviation, r.explained) for r in b]
    assert np.allclose([r.whitened for r in a], [r.whitened for r in b], rtol=1e-12)


def test_blocks_that_outgrow_64_bits(spark, monkeypatch):
    monkeypatch.setattr(whitening, "LONG", 10**13)
    monkeypatch.setattr(whitening, "CELLS", 64)
    frame = spark.createDataFrame([(v,) for v in drawn(5, 80, 6)], "v array<double>").repartition(3)
    n, sums = whitening.dimension_sums(frame, 6)
    x = as_whole(drawn(5, 80, 6))
    matrix = whitening.assemble(n, whitening.squared_sums(frame, 6, np.array([s // n for s in sums])), 6)
    assert matrix.tolist() == [[float(c) for c in row] for row in exact_covariance(x)]


def test_huge_entries(spark):
    draw = random.Random(2)
    vectors = [[draw.uniform(-1e6, 1e6) for _ in range(4)] for _ in range(40)] + [[1e30, -1e30, 0.0, 1.0]]
    rows = collect(table(spark, vectors))
    assert len(rows) == 41 * 4 and all(math.isfinite(r.whitened) for r in rows)
    assert all(r.deviation is None for r in rows if r.id == 40)


def test_odd_rows(spark):
    good = drawn(9, 50, 5)
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [1.0, 2.0, float("inf"), 0.0, 0.0], [1.0, 2.0]]
    ids = [*range(50), None, None, 3, 4, 5, 6, 7, 8]
    vectors = [*good, good[0], good[1], *bad]
    rows = collect(table(spark, vectors, ids))
    assert sum(r.id is None for r in rows) == 10 and len(rows) == 52 * 5
    assert sorted({r.id for r in rows if r.id is not None}) == list(range(50))
    assert all(r.n == 52 and r.identity_error < 1e-9 for r in rows)


def test_components_without_variance(spark):
    flat = [[float(i), 2.0 * i, 1.0] for i in range(30)]
    rows = collect(table(spark, flat))
    assert [r.whitened is None for r in rows[:3]] == [False, True, True]
    assert rows[0].explained == pytest.approx(1) and rows[0].identity_error < 1e-9
    same = collect(table(spark, [[1.0, 2.0]] * 4))
    assert {(r.whitened, r.explained, r.deviation, r.identity_error) for r in same} == {(None, 0.0, 0, 0.0)}
    assert len(same) == 8 and len(collect(table(spark, [[5.0]]))) == 1


def test_empty(spark):
    assert collect(table(spark, [])) == [] == collect(table(spark, [None, []]))
