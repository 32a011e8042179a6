"""Count models and the S-curve against plain solvers, gene by gene."""
import math
import random

import numpy as np
import pytest

from lociq.operators import countmodels as cm
from lociq.operators import curves

DESIGN = {f"l{j}": [1.0, float(j >= 4)] for j in range(8)}
FACTORS = {f"l{j}": f for j, f in enumerate([0.8, 1.0, 1.2, 1.1, 0.9, 1.3, 1.0, 0.7])}


def drawn(genes=200, seed=4):
    rng = np.random.default_rng(seed)
    out = {}
    for g in range(genes):
        mean = 2.0 ** rng.uniform(2, 10)
        alpha = 0.05 + 2 / mean
        fold = 0.0 if g % 4 else rng.choice([-2.0, 2.0])
        mu = np.array([f * mean * 2 ** (fold * x[1]) for f, x in zip(FACTORS.values(), DESIGN.values())])
        out[f"g{g}"] = rng.negative_binomial(1 / alpha, 1 / (1 + alpha * mu)).astype(float)
    out["none"] = np.zeros(8)
    return out


def frame(spark, counts):
    return spark.createDataFrame([(g, c, float(v)) for g, y in counts.items() for c, v in zip(DESIGN, y) if v or g == "none"], "id string, library string, cnt double")


def plain_fit(y, alpha):
    """Newton's steps of one gene's coefficients."""
    x, s = np.array(list(DESIGN.values())), np.array(list(FACTORS.values()))
    b = np.array([math.log((y / s).mean() + 0.1), 0.0])
    for _ in range(200):
        mu = s * np.exp(x @ b)
        grad = x.T @ ((y - mu) / (1 + alpha * mu)) - 1e-6 * 0 * b
        info = (x * (mu * (1 + alpha * y) / (1 + alpha * mu) ** 2)[:, None]).T @ x
        b = b + np.clip(np.linalg.solve(info, grad), -1, 1)
    mu = s * np.exp(x @ b)
    return b, mu, (x * (mu / (1 + alpha * mu))[:, None]).T @ x


def plain_likelihood(la, y, mu):
    x, a = np.array(list(DESIGN.values())), math.exp(la)
    total = sum(math.lgamma(v + 1 / a) - math.lgamma(1 / a) + v * math.log(a * m / (1 + a * m)) - math.log1p(a * m) / a for v, m in zip(y, mu))
    return total - 0.5 * math.log(np.linalg.det((x * (mu / (1 + a * mu))[:, None]).T @ x))


def plain_dispersion(y, mu, prior=lambda la: 0.0):
    grid = np.linspace(math.log(1e-8), math.log(10), 4000)
    return math.exp(max(grid, key=lambda la: plain_likelihood(la, y, mu) + prior(la)))


def test_lgamma():
    x = np.array([1e-6, 0.1, 0.5, 1, 2.5, 7, 30, 1e4, 1e6, 1e8])
    assert np.allclose(cm.lgamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)
    assert math.isclose(cm.trigamma(1.0), math.pi**2 / 6, rel_tol=1e-9)


def test_fits(spark):
    counts = drawn(60)
    df = frame(spark, counts)
    got = {r.id: r for r in cm.gene_dispersions(df, DESIGN, FACTORS).collect()}
    assert got["none"].mean == 0 and got["none"].dispersion is None
    x, s = np.array(list(DESIGN.values())), np.array(list(FACTORS.values()))
    for g, y in list(counts.items())[:25]:
        alpha = cm._moments(y[None], s)[0]
        for _ in range(2):
            _, mu, _ = plain_fit(y, alpha)
            alpha = plain_dispersion(y, mu)
        # Flat likelihoods: both must be as likely.
        a, b = plain_likelihood(math.log(got[g].dispersion), y, mu), plain_likelihood(math.log(alpha), y, mu)
        assert a > b - 1e-4, g
    found = {r.id: r for r in cm.shrunken(df, DESIGN, FACTORS).collect()}
    fits = {r.id: r for r in cm.tested(df, DESIGN, FACTORS, 1).collect()}
    assert fits["none"].p is None
    for g, y in list(counts.items())[:40]:
        b, mu, info = plain_fit(y, found[g].shrunken)
        se = math.sqrt(np.linalg.inv(info)[1, 1])
        assert math.isclose(fits[g].log2_fold, b[1] / math.log(2), rel_tol=1e-4, abs_tol=1e-4) and math.isclose(fits[g].error, se / math.log(2), rel_tol=1e-4)
        assert math.isclose(fits[g].p, math.erfc(abs(b[1] / se) / math.sqrt(2)), rel_tol=1e-3, abs_tol=1e-12)


def test_trend_and_prior(spark):
    rng = np.random.default_rng(1)
    mean = 2.0 ** rng.uniform(1, 12, 4000)
    value = (0.04 + 3 / mean) * rng.gamma(20, 1 / 20, 4000)
    value[:20] *= 100  # off the curve
    df = spark.createDataFrame([(str(i), float(m), float(v)) for i, (m, v) in enumerate(zip(mean, value))] + [("z", 0.0, None), ("y", 5.0, 1e-8)], "id string, mean double, dispersion double")
    a0, a1 = cm.trend(df)
    b = np.array([0.1, 1.0])
    for _ in range(200):
        fit = b[0] + b[1] / mean
        w = np.where((value / fit > 1e-4) & (value / fit < 15), 1 / fit**2, 0)
        x = np.column_stack([np.ones(len(mean)), 1 / mean])
        b = np.linalg.solve((x * w[:, None]).T @ x, (x * w[:, None]).T @ value)
    assert np.allclose([a0, a1], b, rtol=1e-5) and np.allclose([a0, a1], [0.04, 3], rtol=0.1)
    r = np.log(value) - np.log(a0 + a1 / mean)
    want = (np.median(np.abs(r - np.median(r))) * 1.4826) ** 2 - cm.trigamma(50 / 2)
    assert math.isclose(cm.prior_width(df, a0, a1, 50), max(0.25, want), rel_tol=0.02)
    assert cm.trend(df.limit(0)) is not None and cm.prior_width(df.limit(0), 0.1, 1.0, 4) == 0.25


def test_transform_evens_variance(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    rows = [(k, float(v)) for k, m in enumerate([20, 200, 2000]) for v in rng.negative_binomial(1 / (0.05 + 1 / m), 1 / (1 + (0.05 + 1 / m) * m), 4000)]
    got = spark.createDataFrame(rows, "k int, norm double").groupBy("k").agg(F.var_samp(cm.stabilised(F.col("norm"), 0.05, 1.0)).alias("v")).orderBy("k").collect()
    assert max(r.v for r in got) < 1.35 * min(r.v for r in got)
    x = 1234.5
    want = math.log2((1 + 1 + 2 * 0.05 * x + 2 * math.sqrt(0.05 * x * (2 + 0.05 * x))) / 0.2)
    assert math.isclose(spark.range(1).select(cm.stabilised(F.lit(x), 0.05, 1.0)).first()[0], want, rel_tol=1e-12)


@pytest.mark.parametrize("want,noise", [((0.05, 0.9, 1.5, 3.0), 0.0), ((0.0, 1.0, 0.8, 5.0), 0.02), ((10.0, 2.0, 3.0, -1.0), 0.1)])
def test_planted_curves(spark, want, noise):
    rng, c = random.Random(1), curves.Curve(*want)
    points = [(x, c.at(x) + rng.gauss(0, noise)) for x in (rng.uniform(want[3] - 6, want[3] + 6) for _ in range(3000))]
    got = curves.fitted(spark.createDataFrame([*points, (None, 1.0), (1.0, float("nan"))], "x double, y double"))
    low, high, slope = (want[1], want[0], -want[2]) if want[0] > want[1] else want[:3]
    tol = 1e-5 if not noise else 0.12
    assert all(abs(a - b) <= tol * (1 + abs(b)) for a, b in zip((min(got.low, got.high), max(got.low, got.high), abs(got.slope), got.middle), (min(low, high), max(low, high), abs(slope), want[3])))
    (a, _), (b, _) = got.bends()
    assert abs(a - (want[3] - curves.BEND / want[2])) < 0.1 and abs(b - (want[3] + curves.BEND / want[2])) < 0.1
    assert curves.fitted(spark.createDataFrame([(1.0, 2.0)], "x double, y double")) is None and curves.fitted(spark.createDataFrame([], "x double, y double")) is None


def test_genes_are_dealt_by_their_number(spark, monkeypatch):
    """A table of genes is small on disk, but its fits occupy all cores."""
    monkeypatch.setattr(cm, "PIECE", 16)
    assert len(cm.pieces(cm.arrays(frame(spark, drawn(60)), DESIGN)).inputFiles()) >= 4


def test_determinants_and_solutions():
    rng = np.random.default_rng(3)
    x, w, b = rng.normal(size=(12, 5)), rng.uniform(0.1, 5, (7, 12)), rng.normal(size=(5, 7))
    whole = np.einsum("gj,jp,jq->gpq", w, x, x) + 1e-6 * np.eye(5)
    logs, got = cm.eliminated(cm.information(w, x, 1e-6), b.copy())
    assert np.allclose(logs, np.linalg.slogdet(whole)[1]) and np.allclose(got.T, np.linalg.solve(whole, b.T[:, :, None])[:, :, 0])
