"""Small linear models on the driver: logistic regression and Platt calibration on numpy arrays."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 300, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """(weights, bias) by full-batch Adam; classes count alike. One class only: a constant of that class."""
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    if len(y) == 0:
        return w, 0.0
    share = float(np.mean(y))
    if share in (0.0, 1.0):
        return w, 6.0 if share else -6.0
    cost = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share)).astype(np.float32) / len(y)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        d = (sigmoid(x @ w + b) - y).astype(np.float32) * cost
        g = np.append(x.T @ d + l2 * w, d.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate / np.sqrt(t) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), b - step[-1]
    return w, float(b)


def fit_platt(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, c) with P(y = 1) = sigmoid(a z + c), by Newton steps on smoothed targets."""
    if len(y) == 0 or len(np.unique(y)) < 2:
        return 1.0, 0.0
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0.5, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, c = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * z + c)
        r, s = p - target, np.maximum(p * (1 - p), 1e-6)
        h = np.array([[s @ (z * z) + 1e-3, s @ z], [s @ z, s.sum() + 1e-3]])
        da, dc = np.linalg.solve(h, [r @ z, r.sum()])
        a, c = a - np.clip(da, -1, 1), c - np.clip(dc, -1, 1)
    return (float(a), float(c)) if a > 0 else (1.0, 0.0)
