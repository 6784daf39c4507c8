"""Linear support vector machines on small dense arrays, for fits on bounded samples."""

from __future__ import annotations

import numpy as np


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 120, counts: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the squared hinge loss, classes weighted alike.

    ``y`` is 1 or -1; ``counts`` says how often each row stands (once each without it). Accelerated gradient steps of fixed number and size; the result depends on the
    rows alone, not on their order beyond rounding.
    """
    n, d = x.shape
    counts = np.ones(n) if counts is None else counts
    share = counts * np.where(y > 0, 0.5 / max(1, counts[y > 0].sum()), 0.5 / max(1, counts[y < 0].sum())).astype(np.float64)
    reg = 1.0 / (c * 100)
    size = float(np.sqrt(np.einsum("ij,ij->i", x, x).max(initial=1e-12)))
    rate = 1.0 / (2 * (size**2 + 1) + reg)
    w = v = np.zeros(d + 1)
    for k in range(steps):
        margin = y * (x @ v[:d].astype(x.dtype) + v[d])
        slack = np.maximum(0.0, 1.0 - margin)
        pull = -2 * share * slack * y
        grad = np.append(x.T @ pull.astype(x.dtype), pull.sum()) + reg * np.append(v[:d], 0.0)
        fresh = v - rate * grad
        v = fresh + k / (k + 3) * (fresh - w)
        w = fresh
    return w[:d], float(w[d])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_sigmoid(margin: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through margins, with smoothed targets (y 0 or 1)."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margin + b)
        weight = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        h = np.array([[(weight * margin**2).sum() + 1e-3, (weight * margin).sum()], [(weight * margin).sum(), weight.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return float(a), float(b)
