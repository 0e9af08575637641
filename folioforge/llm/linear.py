"""A linear support vector machine for small dense samples on the driver."""

from __future__ import annotations

import numpy as np


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 10.0, rounds: int = 200, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + penalty * mean squared hinge loss, by accelerated gradient; y is -1 or 1."""
    weight = np.ones(len(y)) if weight is None else weight
    kind = x.dtype  # one precision throughout, so that no product copies x
    weight = (penalty * weight / max(weight.sum(), 1e-12)).astype(kind)
    y = y.astype(kind)
    x = np.hstack([x, np.ones((len(x), 1), kind)])
    norm = float(np.einsum("ij,ij,i->", x, x, weight))
    probe = np.random.default_rng(0).normal(size=x.shape[1]).astype(kind)
    for _ in range(20):  # the largest curvature
        probe = x.T @ (weight * (x @ probe))
        size = np.linalg.norm(probe)
        if size == 0:
            break
        probe /= size
    step = kind.type(1 / (1 + 2 * min(norm, 1.1 * float(size))))
    w = v = np.zeros(x.shape[1], kind)
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v))
        grad = v - 2 * (x.T @ (weight * slack * y))
        new = v - step * grad
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + kind.type((t - 1) / t2) * (new - w)
        w, t = new, t2
    return w[:-1], float(w[-1])


def logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 50, weight: np.ndarray | None = None) -> tuple[float, float]:
    """a, b of P(1) = 1 / (1 + exp(-(a * margin + b))), lightly regularised; y is 0 or 1."""
    weight = np.ones(len(y)) if weight is None else weight
    x = np.stack([margin, np.ones(len(margin))], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-2 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(hess, grad)
    return float(w[0]), float(w[1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
