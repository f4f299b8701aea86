"""Logistic regression in numpy, for models small enough for the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights, the last one the intercept, by Newton's method; ``y`` may be probabilities.

    The penalty leaves the intercept alone but for a trace, so that one class
    alone has a finite solution.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-2
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + penalty * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    return w
