"""Count models by gene: dispersions, their trend, shrinkage, the variance-stabilising transform, and negative-binomial regression.

Counts are rows (id, library, cnt). A gene's counts become one array in the order of the design's libraries, and tasks fit all genes of a batch at once. The arrays are
stored in pieces of a number of genes, as what they cost to fit has nothing to do with their size on disk, and each step adds its columns to that table. What holds for all genes (the trend, the prior's width) is fitted from sums that Spark adds up. The design gives each library its row: {library: [1, 0, ...]}.

The mean of gene i in library j is s_j exp(x_j b_i), the variance mean + dispersion * mean^2. Genes without counts have nulls.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import stored

Design = dict[str, list[float]]

#: Limits of a dispersion; genes that are fitted at once, and of a piece of the table; residuals that the trend's fit leaves out.
LEAST, MOST, ROWS, PIECE, OUTLIERS = 1e-8, 10.0, 1024, 8192, (1e-4, 15.0)


def arrays(counts: DataFrame, design: Design) -> DataFrame:
    """id, y: counts in the design's order; 0 where a library has none."""
    x = counts.where(F.col("library").isin(list(design))).groupBy("id")
    x = x.agg(*[F.sum(F.when(F.col("library") == c, F.col("cnt").cast("double"))).alias(f"c{i}") for i, c in enumerate(design)])
    return x.select("id", F.array(*[F.coalesce(f"c{i}", F.lit(0.0)) for i in range(len(design))]).alias("y"))


def pieces(genes: DataFrame) -> DataFrame:
    """A table of genes in enough parts to occupy all cores."""
    genes = stored(genes)
    return stored(genes.repartition(-(-genes.count() // PIECE) or 1))


def lgamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function of numbers over 0, by Stirling's series eight steps up."""
    z, t = x + 8, x * (x + 7)
    u = 1 / z
    v = u * u
    series = u * (1 / 12 - v * (1 / 360 - v * (1 / 1260 - v / 1680)))
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(t * (t + 6) * (t + 10) * (t + 12))  # x (x + 1) ... (x + 7)


def information(w: np.ndarray, x: np.ndarray, ridge: float) -> np.ndarray:
    """x' diag(w) x + ridge for each row of w, rows last."""
    p = x.shape[1]
    out = ((x[:, :, None] * x[:, None, :]).reshape(len(x), -1).T @ w.T).reshape(p, p, -1)
    out[np.arange(p), np.arange(p)] += ridge
    return out


def eliminated(a: np.ndarray, b: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """ln of the determinants of positive definite matrices a[:, :, g], and the solutions of a x = b[:, g]; a and b are used up. All at once, a column at a time."""
    p, total = len(a), np.zeros(a.shape[2])
    for k in range(p):
        total += np.log(np.abs(a[k, k]))
        f = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k + 1 :] -= f[:, None] * a[k, k + 1 :]
        if b is not None:
            b[k + 1 :] -= f * b[k]
    if b is not None:
        for k in range(p - 1, -1, -1):
            b[k] = (b[k] - (a[k, k + 1 :] * b[k + 1 :]).sum(axis=0)) / a[k, k]
    return total, b


def regressed(y: np.ndarray, x: np.ndarray, size: np.ndarray, alpha: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and means of each row of y, by iteratively reweighted least squares. A row that has settled takes no further part."""
    start = np.log(y / size + 0.1)
    beta = np.linalg.lstsq(x, start.T, rcond=None)[0].T
    mean_of = lambda b: size * np.exp(np.clip(b @ x.T, -30, 30))
    left = np.arange(len(y))
    for _ in range(rounds):
        now, own = beta[left], y[left]
        mean = mean_of(now)
        w = mean / (1 + alpha[left, None] * mean)
        z = np.log(mean / size) + (own - mean) / mean
        new = eliminated(information(w, x, 1e-6), x.T @ (w * z).T)[1].T
        step = np.clip(new - now, -5, 5)
        beta[left] = now + step
        left = left[np.abs(step).max(axis=1) >= 1e-10]
        if not len(left):
            break
    return beta, mean_of(beta)


def likelihood(log_alpha: np.ndarray, y: np.ndarray, mean: np.ndarray, log_mean: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Profile log likelihood of dispersions, adjusted by half the log determinant of the information (Cox and Reid)."""
    alpha = np.exp(log_alpha)
    r, am = 1 / alpha, alpha[:, None] * mean
    up = y + r[:, None]
    fit = (lgamma(up) + y * (log_alpha[:, None] + log_mean) - up * np.log1p(am)).sum(axis=1) - y.shape[1] * lgamma(r)
    return fit - 0.5 * eliminated(information(mean / (1 + am), x, 1e-9))[0]


def dispersions(y: np.ndarray, mean: np.ndarray, x: np.ndarray, centre: np.ndarray | None = None, width: float = 0.0) -> np.ndarray:
    """The most likely dispersion of each row, with a normal prior of its log where a centre is given: the best of a grid, then a golden section about it."""
    log_mean = np.log(mean)
    value = lambda g: likelihood(g, y, mean, log_mean, x) - (0 if centre is None else (g - centre) ** 2 / (2 * width))
    grid = np.linspace(math.log(LEAST), math.log(MOST), 21)
    found = np.array([value(np.full(len(y), g)) for g in grid])
    best, most = grid[found.argmax(axis=0)], found.max(axis=0)
    low, high = np.maximum(best - (grid[1] - grid[0]), grid[0]), np.minimum(best + (grid[1] - grid[0]), grid[-1])
    part = (math.sqrt(5) - 1) / 2
    c, d = high - part * (high - low), low + part * (high - low)
    fc, fd = value(c), value(d)
    for _ in range(30):
        left = fc > fd
        low, high = np.where(left, low, c), np.where(left, d, high)
        new = np.where(left, high - part * (high - low), low + part * (high - low))
        f = value(new)
        c, d, fc, fd = np.where(left, new, d), np.where(left, c, new), np.where(left, f, fd), np.where(left, fc, f)
    at, f = np.where(fc > fd, c, d), np.maximum(fc, fd)
    return np.exp(np.where(f > most, at, best))  # the best of the grid where that is a limit


def _frame(design: Design, factors: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    return np.array(list(design.values()), np.float64), np.array([factors[c] for c in design])


def _moments(y: np.ndarray, size: np.ndarray) -> np.ndarray:
    norm = y / size
    m = norm.mean(axis=1)
    return np.clip((norm.var(axis=1, ddof=1) - (1 / size).mean() * m) / m**2, LEAST, MOST)


def _fitted(df: DataFrame, f, names: list[str]) -> DataFrame:
    """df(id, y, ...) with the named columns that f(y, other columns as arrays) gives, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                y = pc.list_flatten(batch.column(1)).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                found = f(y, *[batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, batch.num_columns)])
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.float64(), from_pandas=True) for c in found]], [*batch.schema.names, *names])

    schema = ", ".join([f"`{c.name}` {c.dataType.simpleString()}" for c in df.schema] + [f"{n} double" for n in names])
    return df.mapInArrow(run, schema)


def _dispersed(counts: DataFrame, design: Design, factors: dict[str, float]) -> DataFrame:
    """gene_dispersions' table with y."""
    x, size = _frame(design, factors)

    def f(y: np.ndarray) -> list[np.ndarray]:
        mean, out = (y / size).mean(axis=1), np.full(len(y), np.nan)
        some = mean > 0
        if some.any():
            y = y[some]
            alpha = _moments(y, size)
            for _ in range(2):
                _, mu = regressed(y, x, size, alpha)
                alpha = dispersions(y, mu, x)
            out[some] = alpha
        return [mean, out]

    return _fitted(pieces(arrays(counts, design)), f, ["mean", "dispersion"])


def gene_dispersions(counts: DataFrame, design: Design, factors: dict[str, float]) -> DataFrame:
    """id, mean (of counts by size factor), dispersion of each gene by itself."""
    return _dispersed(counts, design, factors).drop("y")


def trend(found: DataFrame, rounds: int = 50) -> tuple[float, float]:
    """(a0, a1) of dispersion = a0 + a1 / mean over gene_dispersions' table: a gamma regression by reweighted sums, each round one aggregate.

    Genes at the least dispersion, or off the curve by more than OUTLIERS, stay out of a round.
    """
    x = found.where(F.col("dispersion").isNotNull() & (F.col("dispersion") >= 100 * LEAST) & (F.col("mean") > 0))
    x = stored(x.select((1 / F.col("mean")).alias("u"), F.col("dispersion").alias("v")))  # read once a round
    a0, a1 = 0.1, 1.0
    for _ in range(rounds):
        fit = F.lit(a0) + F.lit(a1) * F.col("u")
        ratio = F.col("v") / fit
        w = F.when((ratio > OUTLIERS[0]) & (ratio < OUTLIERS[1]), 1 / (fit * fit)).otherwise(0.0)
        sums = x.agg(*[F.coalesce(F.sum(w * e), F.lit(0.0)) for e in (F.lit(1.0), F.col("u"), F.col("u") * F.col("u"), F.col("v"), F.col("u") * F.col("v"))]).first()
        s, su, suu, sv, suv = sums
        det = s * suu - su * su
        if not det > 1e-12 * s * suu:  # too few genes for a slope
            new = (sv / s if s else a0, 0.0)
        else:
            new = ((sv * suu - suv * su) / det, (s * suv - su * sv) / det)
        new = (max(new[0], 1e-6), max(new[1], 0.0))
        done = abs(new[0] - a0) + abs(new[1] - a1) < 1e-8 * (a0 + a1 + 1e-9)
        a0, a1 = new
        if done:
            break
    return a0, a1


def trigamma(x: float) -> float:
    out = 0.0
    while x < 8:
        out, x = out + 1 / x**2, x + 1
    return out + 1 / x + 1 / (2 * x**2) + 1 / (6 * x**3) - 1 / (30 * x**5) + 1 / (42 * x**7)


def prior_width(found: DataFrame, a0: float, a1: float, free: int) -> float:
    """Variance of the log dispersions about the trend, less what sampling with so many degrees of freedom gives; 0.25 at least."""
    r = F.ln("dispersion") - F.ln(F.lit(a0) + F.lit(a1) / F.col("mean"))
    some = found.where(F.col("dispersion").isNotNull() & (F.col("dispersion") >= 100 * LEAST)).select(r.alias("r"))
    middle = some.agg(F.percentile_approx("r", 0.5, 100000)).first()[0]
    if middle is None:
        return 0.25
    spread = some.agg(F.percentile_approx(F.abs(F.col("r") - F.lit(middle)), 0.5, 100000)).first()[0] * 1.4826
    return max(spread**2 - trigamma(free / 2), 0.25)


def _shrunken(counts: DataFrame, design: Design, factors: dict[str, float]) -> DataFrame:
    """shrunken's table with y."""
    x, size = _frame(design, factors)
    found = stored(_dispersed(counts, design, factors))
    a0, a1 = trend(found)
    free = max(1, x.shape[0] - x.shape[1])
    width = prior_width(found, a0, a1, free)

    def f(y: np.ndarray, mean: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
        expected, out = np.full(len(y), np.nan), np.full(len(y), np.nan)
        some = mean > 0
        if some.any():
            y, own_alpha = y[some], own[some]
            centre = np.log(a0 + a1 / mean[some])
            _, mu = regressed(y, x, size, own_alpha)
            alpha = dispersions(y, mu, x, centre, width)
            expected[some], out[some] = np.exp(centre), np.where(np.log(own_alpha) > centre + 2 * math.sqrt(width), own_alpha, alpha)
        return [expected, out]

    return _fitted(found, f, ["expected", "shrunken"])


def shrunken(counts: DataFrame, design: Design, factors: dict[str, float]) -> DataFrame:
    """id, mean, dispersion, expected (by the trend), shrunken: the most likely dispersion under the prior about the trend; a gene's own where it lies two
    prior widths above."""
    return _shrunken(counts, design, factors).drop("y")


def stabilised(norm: Column, a0: float, a1: float) -> Column:
    """The transform (log2) under which counts by size factor, with dispersions on the trend, have the same variance at all means."""
    root = F.sqrt(F.lit(a0) * norm * (1 + F.lit(a1) + F.lit(a0) * norm))
    return F.log2((1 + F.lit(a1) + 2 * F.lit(a0) * norm + 2 * root) / (4 * F.lit(a0)))


def tested(counts: DataFrame, design: Design, factors: dict[str, float], column: int, found: DataFrame | None = None) -> DataFrame:
    """id, base_mean, log2_fold, error, stat, p: the design's column by Wald's test, with the shrunken dispersions (found: shrunken()'s table)."""
    x, size = _frame(design, factors)
    if found is None:
        genes = _shrunken(counts, design, factors).select("id", "y", "shrunken")
    else:
        genes = pieces(arrays(counts, design).join(found.select("id", "shrunken"), "id"))

    def f(y: np.ndarray, alpha: np.ndarray) -> list[np.ndarray]:
        mean = (y / size).mean(axis=1)
        fold, error, stat, p = (np.full(len(y), np.nan) for _ in range(4))
        some = (mean > 0) & np.isfinite(alpha)
        if some.any():
            beta, mu = regressed(y[some], x, size, alpha[some])
            unit = np.zeros(beta.T.shape)
            unit[column] = 1
            se = np.sqrt(eliminated(information(mu / (1 + alpha[some, None] * mu), x, 1e-6), unit)[1][column])
            fold[some], error[some], stat[some] = beta[:, column] / math.log(2), se / math.log(2), beta[:, column] / se
            p[some] = [math.erfc(abs(z) / math.sqrt(2)) for z in stat[some]]
        return [mean, fold, error, stat, p]

    return _fitted(genes, f, ["base_mean", "log2_fold", "error", "stat", "p"]).drop("y", "shrunken")
