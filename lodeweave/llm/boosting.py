"""Gradient-boosted trees for a yes-or-no answer, in numpy: logistic loss, histogram splits, second-order leaf values."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_BINS = 32


@dataclass
class Trees:
    """Complete binary trees of one depth: per inner node a feature and a threshold, per leaf a value."""

    depth: int
    base: float
    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of rows of features."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - (2**self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, smooth: float = 1.0) -> Trees:
    """Fit trees one after another to the gradient; a node is split where the gain is largest, ties at the first feature."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, _BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1)
    p0 = (y.sum() + 1) / (len(y) + 2)
    model = Trees(depth, float(np.log(p0 / (1 - p0))))
    score = np.full(len(y), model.base)
    n_features = x.shape[1]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        f = np.zeros(2**depth - 1, np.int64)
        t = np.full(2**depth - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first = 2**level - 1
            for k in range(first, 2 * first + 1):
                rows = np.flatnonzero(node == k)
                if len(rows) < 2:
                    continue
                best = 1e-6
                total_g, total_h = g[rows].sum(), h[rows].sum()
                for j in range(n_features):
                    b = binned[rows, j]
                    lg = np.cumsum(np.bincount(b, g[rows], len(cuts[j]) + 1))[:-1]
                    lh = np.cumsum(np.bincount(b, h[rows], len(cuts[j]) + 1))[:-1]
                    if not len(lg):
                        continue
                    gain = lg**2 / (lh + smooth) + (total_g - lg) ** 2 / (total_h - lh + smooth) - total_g**2 / (total_h + smooth)
                    at = int(gain.argmax())
                    if gain[at] > best:
                        best, f[k], t[k] = gain[at], j, cuts[j][at]
            node = 2 * node + 1 + (x[np.arange(len(y)), f[node]] > t[node])
        leaf = node - (2**depth - 1)
        v = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + smooth)
        score += v[leaf]
        model.feature.append(f)
        model.threshold.append(t)
        model.value.append(v)
    return model


def calibration(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's a, b by Newton steps: the probability of a score s is 1 / (1 + exp(-(a s + b)))."""
    up, down = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target = np.where(y > 0.5, up, down)
    a, b = 0.0, float(np.log(target.mean() / (1 - target.mean())))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        grad = np.array([((target - p) * score).sum() - 1e-3 * (a - 1), (target - p).sum()])
        hess = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-6]])
        move = np.linalg.solve(hess, grad)
        a, b = a + move[0], b + move[1]
        if np.abs(move).max() < 1e-8:
            break
    return float(a), float(b)
