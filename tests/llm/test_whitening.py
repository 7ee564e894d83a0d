import numpy as np
import pytest

from loomcast.llm import whitening
from loomcast.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.01"


def symmetric(values, seed=0):
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    found = turn * np.array(values, dtype=float) @ turn.T
    return (found + found.T) / 2


SPECTRA = {
    "spread": np.linspace(1, 500, 40),
    "steep": 10.0 ** np.linspace(3, -6, 30),
    "equal": [7.0] * 20,
    "clusters": [5.0] * 9 + [5.0 + 1e-9] * 3 + [1.0] * 10 + [2.0, 3.0],
    "short rank": [4.0, 3.0, 2.0] + [0.0] * 17,
    "one": [2.5],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_inertia_counts_eigenvalues(name):
    matrix = symmetric(SPECTRA[name])
    values = np.linalg.eigvalsh(matrix)
    cuts = np.array([0.3, 0.9, 1.7, 2.2, 4.1, 6.0, 40.1, 700.0, -1.0])
    counts = whitening.below(whitening.tridiagonal(matrix), cuts)
    assert counts.tolist() == [(values < cut).sum() for cut in cuts]


def test_inertia_of_singular_forms():
    assert whitening.below(whitening.tridiagonal(np.array([[0.0, 1.0], [1.0, 0.0]])), np.array([0.0, -2.0])).tolist() == [1, 0]
    assert whitening.below(whitening.tridiagonal(np.zeros((3, 3))), np.array([1.0, -1.0])).tolist() == [3, 0]


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("wanted", [1, 8, 32])
def test_slices_find_all_leading_pairs(name, wanted):
    matrix = symmetric(SPECTRA[name], seed=wanted)
    values = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    values = values[values > whitening.NOISE * values[0]]
    slices = whitening.spectral_slices(matrix, wanted)
    assert sum(s[2] for s in slices) >= min(wanted, len(values))
    found, vectors = [], []
    for low, high, count in slices:
        own, axes = whitening.eigenpairs_inside(matrix, low, high, count)
        assert np.allclose(matrix @ axes, axes * own, atol=1e-11 * values[0])
        found += list(own)
        vectors.append(axes)
    assert np.allclose(found, values[: len(found)], rtol=0, atol=1e-11 * values[0])
    settled, axes = whitening.settled_pairs(matrix, np.hstack(vectors), wanted)
    assert np.allclose(settled, values[:wanted], rtol=1e-5, atol=1e-13 * values[0])
    assert np.allclose(matrix @ axes, axes * settled, atol=1e-12 * values[0])
    assert np.allclose(axes.T @ axes, np.eye(axes.shape[1]), atol=1e-12)


def brute(rows, components=32):
    kept = [(i, v) for i, v in rows if v and all(e is not None and np.isfinite(e) for e in v)]
    x = [[int(np.floor(64 * float(e))) + 1_000_000 for e in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[(e * n - s) / n for e, s in zip(v, sums)] for v in x])
    cov = y.T @ y / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    use = values > whitening.NOISE * values[0]
    white = y @ axes[:, use] / np.sqrt(values[use])
    deviation = [sum((n * e - s) ** 2 for e, s in zip(v, sums)) for v in x]
    return [i for i, _ in kept], n, deviation, white, values[use] / np.trace(cov)


def check(found, rows):
    ids, n, deviation, white, explained = brute(rows)
    found = sorted(found, key=lambda r: (r.vec_id, r.component))
    k = len(explained)
    assert [r.vec_id for r in found] == [i for i in sorted(ids) for _ in range(k)]
    assert [r.component for r in found] == list(range(1, k + 1)) * len(ids)
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-7
    order = np.argsort(ids, kind="stable")
    assert [r.deviation for r in found[::k]] == [deviation[j] for j in order]
    own = np.array([r.whitened for r in found]).reshape(-1, k)
    signs = np.sign((own * white[order]).sum(axis=0))
    assert np.allclose(own * signs, white[order], atol=1e-7)
    assert np.allclose([r.explained for r in found[:k]], explained, rtol=1e-9)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(QUERIES["op12_whitening"](spark, FOLDER).collect(), rows)


def test_odd_vectors(spark):
    draw = np.random.default_rng(2)
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(e) for e in draw.normal(size=5)]) for k in range(80)]
    rows += [(k, [float(e) for e in draw.normal(size=5)] ) for k in range(90, 95)]
    base = list(rows)
    rows += [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [nan] * 5), (204, [1.0, inf, 0.0, 0.0, 0.0])]
    rows += [(205, [1.0, 2.0]), (206, [1e300] * 5)]
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, id string, component string")
    check(whitening.whiten(table.repartition(3)).collect(), base)


def test_repeated_rows_and_null_ids_count(spark):
    draw = np.random.default_rng(3)
    rows = [(None if k % 5 == 0 else k // 2, [float(e) for e in draw.normal(size=3)]) for k in range(40)]
    table = spark.createDataFrame(rows * 2, "vec_id long, embedding array<float>")
    found = whitening.whiten(table).collect()
    assert len(found) == 80 * 3 and {r.n for r in found} == {80}
    assert sum(r.vec_id is None for r in found) == 2 * 8 * 3


def test_no_variance_and_no_rows(spark):
    shape = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], shape)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], shape)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], shape)).count() == 0


def test_exact_deviation_or_null():
    sums = np.array([3, 5], dtype=np.int64)
    model = whitening.Whitening(7, sums, np.ones(1), np.ones((2, 1)), 1.0, 0.0, 64, 0)
    large = np.array([[400_000_000, 1], [2**61, 2]], dtype=np.int64)
    assert model.deviation(large).to_pylist() == [(7 * 400_000_000 - 3) ** 2 + 4, None]
