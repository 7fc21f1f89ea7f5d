import random

import numpy as np
import pytest

from tessera.llm import queries
from tessera.llm.whitening import Whitening, eigen, pivoted_cholesky, whiten_vectors
from tests.conftest import SF_SMALL
from tests.llm.helpers import with_clashes

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, components=16):
    """numpy's own eigenvalues over the distinct quantised vectors of the usual length."""
    good = [(i, v) for i, v, *_ in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    width = max(set(sizes), key=lambda s: (sizes.count(s), s))
    good = [(i, np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000) for i, v in good if len(v) == width]
    fit = np.unique(np.stack([x for _, x in good]), axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    rank = np.linalg.matrix_rank(cov, hermitian=True)
    values, vectors = values[::-1][: min(rank, components)], vectors[:, ::-1][:, : min(rank, components)]
    out = []
    for i, x in good:
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        white = (x - sums / n) @ vectors / np.sqrt(values)
        out += [(i, k + 1, n, deviation, white[k], values[k] / np.trace(cov)) for k in range(len(values))]
    return out


def compare(rows, want, sign=True):
    key = lambda r: (str(r[0]), r[1], r[3], abs(r[4]))
    got = sorted(((r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained) for r in rows), key=key)
    want = sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([abs(g[4]) for g in got], [abs(w[4]) for w in want], rtol=1e-6, atol=1e-8)
    np.testing.assert_allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    if sign:  # one sign per component for all rows
        for k in {g[1] for g in got}:
            pairs = [(g[4], w[4]) for g, w in zip(got, want, strict=True) if g[1] == k and abs(w[4]) > 1e-3]
            assert len({np.sign(a * b) for a, b in pairs}) <= 1
    assert all(r.identity_error < 1e-9 for r in rows)


@pytest.mark.parametrize("p,rank", [(1, 1), (2, 2), (5, 5), (12, 7), (40, 40), (33, 12)])
def test_eigen_against_numpy(p, rank):
    rng = np.random.default_rng(p)
    half = rng.normal(size=(p, rank)) * np.logspace(0, -4, rank)
    c = half @ half.T
    values, rows = eigen(c)
    want = np.linalg.eigvalsh(c)[::-1][:rank]
    assert len(values) >= rank and (np.diff(values) <= 0).all()
    np.testing.assert_allclose(values[:rank], want, rtol=1e-6, atol=1e-14 * c.max() * p)
    np.testing.assert_allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-9 if len(rows) == rank else 1e-3)
    np.testing.assert_allclose(rows[:rank] @ c, values[:rank, None] * rows[:rank], atol=1e-12 * c.max() * p)


def test_small_eigenvalues_keep_their_precision():
    scale = np.logspace(0, -9, 8)
    values, _ = eigen(np.diag(scale[[3, 0, 7, 5, 1, 2, 6, 4]]))
    np.testing.assert_allclose(values, scale, rtol=1e-14)


def test_cholesky_gives_the_matrix_back_in_pivot_order():
    half = np.random.default_rng(4).normal(size=(9, 9))
    c = half @ half.T
    factor, order = pivoted_cholesky(c)
    np.testing.assert_allclose(factor @ factor.T, c[np.ix_(order, order)], atol=1e-12)
    assert np.allclose(factor, np.tril(factor)) and (np.diff(np.diag(factor)) <= 1e-12).all()
    assert pivoted_cholesky(np.zeros((3, 3)))[0].shape == (3, 0)


def odd_vectors(n=80, width=20, seed=6):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.1 * k, 1 + k % 3) for k in range(width)], i % 3) for i in range(n)]
    rows += [(n + i, rows[3][1], 0) for i in range(n)]  # a group of copies
    rows += [rows[5], rows[5], (None, rows[8][1], 1), (None, [0.25] * width, None)]
    rows += [(900, None, 0), (901, [], 0), (902, [None] * width, 0), (903, [float("nan")] + [0.0] * (width - 1), 0)]
    rows += [(904, [float("-inf")] + [0.0] * (width - 1), 0), (905, [1.0, 2.0], 0), (906, [0.5] * (width + 1), 0), (907, [-0.0] * width, 0)]
    return rows


def test_matches_numpy_on_odd_rows(spark):
    rows = odd_vectors()
    got = whiten_vectors(with_clashes(spark.createDataFrame(rows, VECTORS))).collect()
    compare(got, brute(rows))


def test_fewer_directions_than_components(spark):
    rng = random.Random(9)
    base = [[rng.gauss(0, 3) for _ in range(10)] for _ in range(2)]
    rows = [(i, [round(64 * (a * i + b * (i * i % 7))) / 64 for a, b in zip(*[[round(x * 64) for x in v] for v in base], strict=True)], 0) for i in range(30)]
    got = whiten_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.component for r in got} == {1, 2}
    compare(got, brute(rows))


def test_tables_without_a_direction(spark):
    assert whiten_vectors(spark.createDataFrame([], VECTORS)).collect() == []
    assert whiten_vectors(spark.createDataFrame([(1, None, 0), (2, [], 0)], VECTORS)).collect() == []
    assert whiten_vectors(spark.createDataFrame([(i, [0.5, 0.25], 0) for i in range(5)], VECTORS)).collect() == []


def test_deviation_is_exact_beyond_64_bits():
    n, sums = 3_000_000_007, [3_000_000_007 * 1_000_000 + 5, 3_000_000_007 * 999_990 + 1]
    w = Whitening(n, sums, np.ones(1), np.eye(2)[:1], 2.0)
    x = np.array([[1_000_900, 999_000], [10, 999_990]], dtype=np.int64)
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    assert [int(v) for v in w.deviation(x).to_pylist()] == want and max(want) > 2**63


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    df = queries.queries()["op13_whitening"](spark, SF_SMALL)
    assert dict(df.dtypes)["deviation"] == "bigint"
    compare(df.collect(), brute(rows))
