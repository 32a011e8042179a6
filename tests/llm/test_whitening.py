"""Whitening against eigenvectors of a plain solver, exact sums, equal roots, and awkward rows."""
import math
from fractions import Fraction

import numpy as np
import pytest

from lociq.llm import queries, whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, x string, n int, whitened string, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "y", 0) for i, v in rows], SCHEMA)


def plain(rows, most=4):
    """Whole numbers of each row that stays, and the exact covariance of the distinct ones."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in kept), default=0)
    xs = [(i, tuple(math.floor(256 * c) for c in v) + (0,) * (d - len(v))) for i, v in kept]
    fit = sorted({x for _, x in xs})
    n = len(fit)
    sums = [sum(x[j] for x in fit) for j in range(d)]
    cov = [[sum(Fraction(n * x[i] - sums[i], n) * Fraction(n * x[j] - sums[j], n) for x in fit) / n for j in range(d)] for i in range(d)]
    return xs, fit, n, sums, cov


def check(got, rows, most=4, apart=True):
    xs, fit, n, sums, cov = plain(rows)
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in r] for r in cov]))
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-9 * max(values[0], 1e-300)).sum()))
    assert len(got) == k * len(xs)
    trace = float(sum(cov[i][i] for i in range(len(cov))))
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    for c, some in by.items():
        assert all(r.n == n and math.isclose(r.explained, values[c - 1] / trace, rel_tol=1e-9) and r.identity_error <= 1e-9 for r in some)
        assert sorted((str(r.vec_id), r.deviation) for r in some) == sorted((str(i), sum((n * a - b) ** 2 for a, b in zip(x, sums))) for i, x in xs)
        if apart:
            want = {x: float(np.dot([float(Fraction(n * a - b, n)) for a, b in zip(x, sums)], vectors[:, c - 1]) / math.sqrt(values[c - 1])) for _, x in xs}
            first = {str(i): want[x] for i, x in xs}
            sign = np.sign(sum(r.whitened * first[str(r.vec_id)] for r in some if r.vec_id is not None))
            assert all(math.isclose(sign * r.whitened, first[str(r.vec_id)], abs_tol=1e-8) for r in some if r.vec_id is not None)


def drawn(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=d) * (1.5 ** -np.arange(d)) @ np.linalg.qr(rng.normal(size=(d, d)))[0] if i < 0 else rng.normal(size=d) * (1.5 ** -np.arange(d))).tolist()) for i in range(n)]


@pytest.mark.parametrize("rows", [drawn(300, 8), drawn(5, 7), drawn(40, 3) * 3, [(i, [i * 0.01]) for i in range(9)]])
def test_as_a_plain_solver(spark, rows):
    check(whitening.whitened(frame(spark, rows)).collect(), rows)


def test_awkward_rows(spark):
    rows = [*drawn(60, 5), (101, [0.5, 0.25]), (2, None), (3, [1.0, None, 2.0, 0.0, 0.0]), (4, [NAN] * 5), (5, [INF, 0.0, 0.0, 0.0, 0.0]), (None, [0.1] * 5), (None, [0.1] * 5), (106, [])]
    check(whitening.whitened(frame(spark, rows)).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, []), (2, [])], [(1, [NAN])]])
def test_no_spread_gives_no_rows(spark, rows):
    out = whitening.whitened(frame(spark, rows))
    assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_equal_roots_have_an_orthonormal_basis(spark):
    rows = [(2 * i + s, [float((i == j) * (1 - 2 * s)) for j in range(6)]) for i in range(6) for s in (0, 1)]
    got = whitening.whitened(frame(spark, rows)).collect()
    check(got, rows, apart=False)
    assert {round(r.explained, 12) for r in got} == {round(1 / 6, 12)}


def test_close_roots_and_large_entries(spark):
    """Roots that doubles can hardly part, and entries that need several limbs; a deviation beyond a long is null."""
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1 + 2.0**-8]), (3, [0.0, -1.0])]
    check(whitening.whitened(frame(spark, rows)).collect(), rows)
    big = [(0, [2.0**40, 1.0, 0.0]), (1, [-(2.0**40), 0.0, 1.0]), (2, [0.0, 2.0**39, 5.0]), (3, [1e300, 3.0, -1e300])]
    got = whitening.whitened(frame(spark, big)).collect()
    assert len(got) == 12 and all(r.deviation is None and r.identity_error < 1e-6 for r in got if r.vec_id == 3)


def test_exact_pieces():
    rng = np.random.default_rng(3)
    x = rng.integers(-(2**63), 2**63 - 1, (50, 4))
    assert [[sum(int(part[i, j]) << (16 * k) for k, part in enumerate(whitening.limbs(x))) for j in range(4)] for i in range(50)] == x.tolist()
    p = np.array([2147483647, 2147483629, 101], np.int64)
    a = rng.integers(0, 50, (5, 5))
    a[1:, 0] = 0  # no pivot in the first column
    want = np.round(np.poly(a)).astype(int)
    got = whitening.char_poly(np.array([a % q for q in p]), p)
    assert all((want - g) @ np.ones(6, int) % q == 0 and ((want - g) % q == 0).all() for g, q in zip(got, p))
    assert [whitening.above([1, 6, 11, 6], a, 1) for a in (0, 1, 2, 3, 4, 6)] == [3, 3, 2, 2, 1, 0]  # roots 1, 2, 3
    assert [round(float(r), 12) for r in whitening.roots([1, 6, 12, 8], 4)] == [2.0] * 3


def test_query(spark):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pydict()
    rows = list(zip(t["vec_id"], t["embedding"]))
    xs = np.array([[math.floor(256 * c) for c in v] for _, v in rows], np.int64)
    fit = np.unique(xs, axis=0)
    v = np.cov(fit.T, bias=True)
    values, vectors = np.linalg.eigh(v)
    got = queries.op12_whitening(spark, "/root/testdata/sf0.001").toPandas()
    assert len(got) == 4 * len(rows) and got.identity_error.max() <= 1e-9
    for c in range(1, 5):
        some = got[got.component == c].sort_values("vec_id")
        order = np.argsort(t["vec_id"])
        want = ((xs - fit.mean(axis=0)) @ vectors[:, -c] / math.sqrt(values[-c]))[order]
        assert np.allclose(some.whitened * np.sign(some.whitened.to_numpy() @ want), want, atol=1e-9)
        assert np.allclose(some.explained, values[-c] / values.sum(), rtol=1e-9)
