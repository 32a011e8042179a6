"""Gradient-boosted trees for a small table of numbers, in numpy."""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from .common import platt, sigmoid


@dataclass
class Trees:
    """Each tree: for every inner node of a full binary tree a feature and a limit (go right above it), and a value for every leaf."""

    depth: int = 3
    start: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    limits: list[np.ndarray] = field(default_factory=list)
    values: list[np.ndarray] = field(default_factory=list)

    def leaf(self, x: np.ndarray, feature: np.ndarray, limit: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
        return at - (2**self.depth - 1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((v[self.leaf(x, f, c)] for f, c, v in zip(self.features, self.limits, self.values)), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.logit(x) + self.shift)


def best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray, penalty: float, bins: int = 32) -> tuple[int, float]:
    """Feature and limit with the largest gain; a limit of infinity if none gains."""
    best, found = 1e-9, (0, np.inf)
    whole = g.sum() ** 2 / (h.sum() + penalty)
    for j in range(x.shape[1]):
        limits = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[:-1], method="lower")) if len(x) else ()
        for c in limits:
            right = x[:, j] > c
            gr, hr = g[right].sum(), h[right].sum()
            gain = gr**2 / (hr + penalty) + (g.sum() - gr) ** 2 / (h.sum() - hr + penalty) - whole
            if gain > best and right.any():
                best, found = gain, (j, float(c))
    return found


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, penalty: float = 1.0) -> Trees:
    out = Trees(depth)
    out.start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    z = np.full(len(y), out.start)
    for _ in range(trees):
        p = sigmoid(z)
        g, h = y - p, p * (1 - p)
        feature, limit = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        at = np.zeros(len(y), np.int64)
        for node in range(2**depth - 1):
            here = at == node
            feature[node], limit[node] = best_split(x[here], g[here], h[here], penalty)
            at[here] = 2 * node + 1 + (x[here, feature[node]] > limit[node])
        leaf = at - (2**depth - 1)
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + penalty)
        z += value[leaf]
        out.features.append(feature)
        out.limits.append(limit)
        out.values.append(value)
    return out


def calibrate(trees: Trees, x: np.ndarray, y: np.ndarray) -> None:
    """Sets slope and shift from rows that weren't trained on."""
    trees.slope, trees.shift = platt(trees.logit(x), y)
