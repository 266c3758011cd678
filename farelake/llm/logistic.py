"""Logistic regression, for a bounded table of features on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50, 50)))


def _loss(design: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: np.ndarray) -> float:
    z = design @ w
    return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(penalty * w * w))


def fit(
    x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50, positive: bool = False
) -> tuple[np.ndarray, float]:
    """Weights and intercept; the ridge penalty spares the intercept. With ``positive`` no weight is below zero. One
    class only gives its base rate."""
    n, k = x.shape
    rate = (y.sum() + 0.5) / (n + 1.0)
    bias = float(np.log(rate / (1 - rate)))
    if n == 0 or y.min(initial=1) == y.max(initial=0):
        return np.zeros(k), bias
    design = np.column_stack([x, np.ones(n)]).astype(np.float64)
    penalty = np.append(np.full(k, ridge), 1e-6)
    w = np.append(np.zeros(k), bias)
    w = _bounded(design, y, w, penalty) if positive else _newton(design, y, w, penalty, steps)
    return w[:-1], float(w[-1])


def _newton(design: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: np.ndarray, steps: int) -> np.ndarray:
    loss = _loss(design, y, w, penalty)
    for _ in range(steps):
        p = sigmoid(design @ w)
        slope = design.T @ (p - y) + penalty * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-6 and _loss(design, y, w - size * step, penalty) > loss - 1e-4 * size * (slope @ step):
            size /= 2
        w = w - size * step
        before, loss = loss, _loss(design, y, w, penalty)
        if before - loss < 1e-9 * max(1.0, loss):
            break
    return w


def _bounded(design: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: np.ndarray, steps: int = 1500) -> np.ndarray:
    """Accelerated gradient steps, each followed by setting negative weights (not the intercept) to zero."""
    v = np.ones(design.shape[1])
    for _ in range(30):
        v = design.T @ (design @ v)
        v /= np.linalg.norm(v)
    rate = 1.0 / (0.26 * np.linalg.norm(design @ v) ** 2 + penalty.max())
    ahead, t = w, 1.0
    for _ in range(steps):
        new = ahead - rate * (design.T @ (sigmoid(design @ ahead) - y) + penalty * ahead)
        new[:-1] = np.maximum(new[:-1], 0.0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (before - 1) / t * (new - w)
        if np.abs(new - w).max() < 1e-6:
            return new
        w = new
    return w
