"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from telemill.llm import whitening as W


def dense(vectors):
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    a = x - x.mean(0)
    e, v = np.linalg.eigh(a.T @ a / len(x))
    return x, a, e[::-1], v[:, ::-1]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, n int, `a.b` string")


def collected(spark, rows, components=32):
    whole = W.whole_rows(table(spark, rows).repartition(3))
    model = W.fit(whole, components)
    return model, [] if model is None else W.transform(whole, model).collect()


@pytest.mark.parametrize("n,dims,components", [(200, 12, 5), (60, 40, 32), (9, 20, 32)])
def test_components_whitening_and_exact_deviations(spark, n, dims, components):
    rng = np.random.default_rng(n)
    vectors = (rng.standard_normal((n, dims)) @ rng.standard_normal((dims, dims))).astype(np.float32).tolist()
    model, got = collected(spark, list(enumerate(vectors)), components)
    x, a, e, v = dense(vectors)
    c = min(components, dims, n - 1)
    assert model.n == n and model.components.shape == (dims, c)
    assert np.allclose(model.eigenvalues, e[:c], rtol=1e-12)
    assert np.allclose(model.explained, e[:c] / e.sum(), rtol=1e-12)
    assert np.abs(np.abs(model.components.T @ v[:, :c]) - np.eye(c)).max() < 1e-9
    assert model.identity_error < 1e-9
    sums = [int(s) for s in x.sum(0)]
    for r in got:
        assert r.deviation == sum((n * int(p) - s) ** 2 for p, s in zip(x[r.id], sums))
        assert np.allclose(r.whitened, a[r.id] @ model.components / np.sqrt(model.eigenvalues), rtol=1e-9, atol=1e-9)


def test_equal_eigenvalues_are_all_found(spark):
    """Opposite unit vectors: every direction has the same deviation, and one dimension has none."""
    vectors = [[float(s * (k == j)) for k in range(6)] + [0.5] for j in range(6) for s in (1, -1)]
    model, got = collected(spark, list(enumerate(vectors)))
    assert np.allclose(model.eigenvalues, [64 * 64 * 2 / 12] * 6) and model.identity_error < 1e-12
    assert np.allclose(model.components.T @ model.components, np.eye(6)) and len(got) == 12


def test_early_end_for_many_dimensions(spark, monkeypatch):
    monkeypatch.setattr(W, "ALL_STEPS", 8)
    rng = np.random.default_rng(2)
    scale = np.array([50.0, 50.0, 20.0, 20.0, *([0.3] * 60)])
    vectors = (rng.standard_normal((400, 64)) * scale).astype(np.float32).tolist()
    steps = []
    bidiagonal = W._bidiagonal
    monkeypatch.setattr(W, "_bidiagonal", lambda f, d, w: bidiagonal(lambda *a: (steps.append(1), f(*a))[1], d, w))
    model, _ = collected(spark, list(enumerate(vectors)), 4)
    _, _, e, _ = dense(vectors)
    assert np.allclose(model.eigenvalues, e[:4], rtol=1e-10) and len(steps) < 64


def test_unusable_vectors_repeated_rows_and_null_ids(spark):
    good = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [0.5, 0.25]]
    rows = [(1, good[0]), (2, good[1]), (None, good[2]), (2, good[3]), (5, None), (6, [1.0, None]), (7, [float("nan"), 1.0]),
            (8, [float("inf"), 1.0]), (9, []), (10, [1.0, 2.0, 3.0]), (11, [1e20, 1.0])]
    model, got = collected(spark, rows)
    assert model.n == 4 and sorted(str(r.id) for r in got) == ["1", "2", "2", "None"]
    _, _, e, _ = dense(good)
    assert np.allclose(model.eigenvalues, e)


def test_rows_without_deviation_and_empty_tables(spark):
    assert collected(spark, [])[0] is None
    for rows in ([(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        model, got = collected(spark, rows)
        assert model.components.shape[1] == 0 and all(r.whitened == [] and r.deviation == 0 for r in got)


def test_sums_are_merged_in_levels(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN", 2)
    vectors = np.random.default_rng(3).standard_normal((50, 4)).astype(np.float32).tolist()
    whole = W.whole_rows(table(spark, list(enumerate(vectors)))).repartition(7)
    assert np.allclose(W.fit(whole).eigenvalues, dense(vectors)[2])


def test_a_deviation_beyond_a_long_is_null():
    x = np.array([[0, 0], [2**50, 2**50]])
    n, sums = 2, [2**50, 2**50]
    assert W._deviations(x, n, sums) == [None, None]
    assert W._deviations(x // 2**30, 2, [2**20, 2**20]) == [2 * 2**40] * 2
