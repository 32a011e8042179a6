"""S-curve of a value over a logarithm, and where it bends: cut-offs of coverage and expression.

y = low + (high - low) / (1 + exp(-slope * (x - middle))), by Gauss-Newton steps with Levenberg's damping. A step's sums (the square of the four derivatives and
their products with the residuals) are one aggregate of the table; only these sums come to the driver.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import stored

#: Fixed value: where the logistic function bends most, its third derivative's zeros, in units of 1 / slope.
BEND = math.log(2 + math.sqrt(3))


@dataclass(frozen=True)
class Curve:
    low: float
    high: float
    slope: float
    middle: float

    def at(self, x: float) -> float:
        return self.low + (self.high - self.low) / (1 + math.exp(-self.slope * (x - self.middle)))

    def bends(self) -> tuple[tuple[float, float], tuple[float, float]]:
        """(x, y) where the rise begins and where it ends."""
        a, b = sorted((self.middle - BEND / self.slope, self.middle + BEND / self.slope))
        return (a, self.at(a)), (b, self.at(b))


def _share(x: Column, slope: float, middle: float) -> Column:
    return 1 / (1 + F.exp(F.greatest(F.lit(-500.0), F.least(F.lit(500.0), -F.lit(slope) * (x - F.lit(middle))))))


def fitted(points: DataFrame, x: str = "x", y: str = "y", rounds: int = 200) -> Curve | None:
    """The least-squares curve of points; None where there are fewer than five different x. Null and NaN points are left out."""
    good = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double"))
    points = stored(points.where(good).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))
    cut = points.agg(F.percentile_approx("x", [0.05, 0.25, 0.5, 0.75, 0.95], 10000), F.percentile_approx("y", [0.02, 0.98], 10000), F.approx_count_distinct("x"), F.stddev_pop("x")).first()
    if not cut[0] or cut[2] < 5 or not cut[3]:
        return None
    starts = [np.array([cut[1][0], cut[1][1], 4 / cut[3], m]) for m in cut[0][1:4]]

    def sums(t: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        p = _share(F.col("x"), float(t[2]), float(t[3]))
        bell = (float(t[1]) - float(t[0])) * p * (1 - p)
        d = [1 - p, p, bell * (F.col("x") - float(t[3])), -bell * float(t[2])]
        r = F.col("y") - (float(t[0]) + (float(t[1]) - float(t[0])) * p)
        held = points.select(r.alias("r"), *[c.alias(f"d{i}") for i, c in enumerate(d)])
        pairs = [(i, j) for i in range(4) for j in range(i + 1)]
        row = held.agg(*[F.sum(F.col(f"d{i}") * F.col(f"d{j}")) for i, j in pairs], *[F.sum(F.col(f"d{i}") * F.col("r")) for i in range(4)], F.sum(F.col("r") * F.col("r"))).first()
        a = np.zeros((4, 4))
        for (i, j), v in zip(pairs, row):
            a[i, j] = a[j, i] = v
        return a, np.array(row[10:14]), row[14]

    # The best of a few places for the middle, then steps from there.
    tried = [(sums(t), t) for t in starts]
    (a, g, cost), t = min(tried, key=lambda z: z[0][2])
    damp = 1e-3
    for _ in range(rounds):
        step = np.linalg.solve(a + damp * np.diag(np.diag(a) + 1e-12), g)
        new = t + step
        a2, g2, cost2 = sums(new)
        if cost2 <= cost:
            small = cost - cost2 <= 1e-14 * cost and np.abs(step).max() <= 1e-8 * (1 + np.abs(t).max())
            t, a, g, cost, damp = new, a2, g2, cost2, damp / 5
            if small or cost == 0:
                break
        else:
            damp *= 7
            if damp > 1e12:
                break
    low, high, slope, middle = map(float, t)
    return Curve(high, low, -slope, middle) if slope < 0 else Curve(low, high, slope, middle)
