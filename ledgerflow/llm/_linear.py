"""A hashed linear model: sparse rows, logistic regression by Adam, Platt calibration (numpy)."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train(row: np.ndarray, col: np.ndarray, val: np.ndarray, y: np.ndarray, dims: int,
          steps: int = 80, rate: float = 0.25, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a class-balanced logistic regression on sparse rows."""
    n = len(y)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    w, b = np.zeros(dims), 0.0
    m, v, mb, vb = np.zeros(dims), np.zeros(dims), 0.0, 0.0
    for t in range(1, steps + 1):
        g = (sigmoid(np.bincount(row, w[col] * val, minlength=n) + b) - y) * share
        gw, gb = np.bincount(col, g[row] * val, minlength=dims) + l2 * w / dims, g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        w -= rate * fix * m / (np.sqrt(v) + 1e-8)
        b -= rate * fix * mb / (np.sqrt(vb) + 1e-8)
    return w, float(b)


def calibrate(x: np.ndarray, y: np.ndarray, prior: float = 0.5, steps: int = 60) -> np.ndarray:
    """Logistic calibration on the columns of ``x`` (Newton steps, Platt's smoothed targets), as if
    a share ``prior`` of all rows were positive: coefficients, the constant last. With one class
    only, its smoothed share."""
    pos, neg = float((y > 0).sum()), float((y <= 0).sum())
    a = np.column_stack([x, np.ones(len(y))])
    coef = np.zeros(a.shape[1])
    if not pos or not neg:
        coef[-1] = np.log((pos + 1.0) / (neg + 1.0))
        return coef
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    share = np.where(y > 0, prior / pos, (1 - prior) / neg)
    for _ in range(steps):
        p = sigmoid(a @ coef)
        hess = (a * (share * p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-6 * np.eye(a.shape[1])
        coef -= np.clip(np.linalg.solve(hess, a.T @ ((p - target) * share) + 1e-6 * coef), -5, 5)
    return coef
