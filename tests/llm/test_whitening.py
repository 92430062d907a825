"""Contour integration against numpy's eigenvalues; whitening against a plain version of the contract."""
import math

import numpy as np
import pytest
from helpers import frame
from millrace.llm import feast, whitening


def symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values, float)) @ q.T


SPECTRA = {
    "even": np.linspace(1, 2, 40), "steep": 10.0 ** -np.arange(12), "ties": [5, 5, 5, 5, 5, 4, 4, 4, 4, 4, 4, 1, 1],
    "all_alike": [3.0] * 11, "low_rank": [9, 4, 1] + [0] * 20, "one": [2.0], "two": [2.0, 1.0],
    "near_ties": [1 + 1e-9 * i for i in range(10)] + [0.5] * 10, "huge_range": [1e12, 1e6, 3, 2, 1, 1e-3],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_largest_eigenpairs(spark, name):
    a = symmetric(SPECTRA[name], 3)
    a = (a + a.T) / 2
    values, vectors = feast.largest(spark, a, 8)
    expected = np.sort(np.linalg.eigvalsh(a))[::-1][:8]
    scale = expected[0]
    assert np.abs(values - expected).max() < 1e-13 * scale * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 1e-12 * scale


def test_inertia_counts_eigenvalues():
    for seed in range(5):
        a = symmetric(np.random.default_rng(seed).standard_normal(17), seed)
        bands = feast.tridiagonal(a)
        true = np.sort(np.linalg.eigvalsh(a))[::-1]
        shifts = np.concatenate([(true[1:] + true[:-1]) / 2, [true[0] + 1, true[-1] - 1]])
        assert feast.count_above(*bands, shifts).tolist() == [int((true > s).sum()) for s in shifts]
        low, high = feast.located(*bands, 9)
        assert np.abs((low + high) / 2 - true[:9]).max() < 1e-13 * np.abs(true).max() * 17


def plain(rows):
    """The contract in Python numbers and numpy's own eigenvectors."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:8]
    white = centred @ vectors[:, order] / np.sqrt(values[order])
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    return [i for i, _ in good], n, deviation, white, values[order] / values.sum()


def collection(seed, n, size):
    r = np.random.default_rng(seed)
    scale = r.uniform(0.05, 0.5, size)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(r.standard_normal((n, size)) * scale)]
    return rows + [rows[3], (n, None), (n + 1, [0.1] * (size - 1) + [None]), (n + 2, [float("nan")] + [0.0] * (size - 1)),
                   (n + 3, [float("inf")] * size), (n + 4, [0.0] * size), (None, [0.25] * size), (n + 5, [])]


@pytest.mark.parametrize("size", [3, 12, 33])
def test_equal_to_a_plain_version(spark, size):
    rows = collection(size, 700, size)
    df = frame(spark, rows, "vec_id long, embedding array<float>")
    model = whitening.fit(df)
    got = whitening.whiten(df, model).collect()
    ids, n, deviation, white, explained = plain(rows)
    k = min(8, size)
    assert sorted((str(r.vec_id), r.component, r.n, r.deviation) for r in got) == sorted(
        (str(i), c + 1, n, d) for i, d in zip(ids, deviation) for c in range(k))
    by_row = {(r.vec_id, r.component): r.whitened for r in got}
    for c in range(k):
        mine = np.array([by_row[i, c + 1] for i in ids])
        assert min(np.abs(mine - white[:, c]).max(), np.abs(mine + white[:, c]).max()) < 1e-8
    assert np.allclose([r.explained for r in got if r.vec_id == 0], explained[:k], rtol=1e-10)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-10


def test_few_alike_mixed_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    run = lambda rows: (lambda df: whitening.whiten(df, whitening.fit(df)).collect())(frame(spark, rows, schema))
    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [])]) == []
    assert run([(1, [0.5, 0.5])]) == [] and run([(1, [0.5]), (2, [0.5])]) == []
    one = run([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0, 2.0])])      # one direction, one vector of another length
    assert sorted((r.vec_id, r.component, r.deviation, round(abs(r.whitened), 12)) for r in one) == [
        (1, 1, 1024 ** 2, 1.0), (2, 1, 1024 ** 2, 1.0)]
    large = run([(1, [0.0]), (2, [2.0 ** 30]), (3, [2.0 ** 60])])
    assert [r.deviation for r in large] == [None, None] and {round(abs(r.whitened), 9) for r in large} == {1.0}
