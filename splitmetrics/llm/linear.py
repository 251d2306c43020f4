"""Linear models for bounded samples: logistic regression, linear support vector machine, Platt scaling.

They are fitted on the driver, by gradient descent with momentum on a matrix whose rows are bounded by
the callers' documented sample sizes. Every run gives the same weights.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def _descend(
    gradient: Callable[[np.ndarray], np.ndarray], start: np.ndarray, step: float, rounds: int
) -> np.ndarray:
    weights, before = start, start
    for k in range(rounds):
        ahead = weights + k / (k + 3) * (weights - before)
        before, weights = weights, ahead - step * gradient(ahead)
    return weights


def _with_constant(features: np.ndarray) -> np.ndarray:
    return np.hstack([features, np.ones((len(features), 1), features.dtype)])


def _norm(x: np.ndarray) -> float:
    """The largest eigenvalue of the rows' mean outer product."""
    v = np.ones(x.shape[1], x.dtype) / np.sqrt(x.shape[1], dtype=x.dtype)
    for _ in range(20):
        v = x.T @ (x @ v) / x.dtype.type(len(x))
        size = np.linalg.norm(v)
        v = v / x.dtype.type(max(size, 1e-12))
    return float(max(size, 1e-12))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def logistic(
    features: np.ndarray, classes: np.ndarray, count: int, penalty: float = 1e-5, rounds: int = 300
) -> np.ndarray:
    """Weights of a multinomial logistic regression: a row per class, the constant last."""
    x = _with_constant(features)
    target = np.eye(count, dtype=x.dtype)[classes]

    def gradient(w: np.ndarray) -> np.ndarray:
        return (softmax(x @ w.T) - target).T @ x / len(x) + penalty * w

    return _descend(gradient, np.zeros((count, x.shape[1]), x.dtype), 1 / (_norm(x) / 2 + penalty), rounds)


def binary_logistic(
    x: np.ndarray, shares: np.ndarray, positive: np.ndarray, penalty: float = 1e-5, rounds: int = 300
) -> np.ndarray:
    """Weights of a logistic regression, over rows with a weight each; ``x`` brings its column of ones.

    The matrix is used as it is, so no copy of it is made.
    """
    target = positive.astype(x.dtype)
    each = (shares / max(shares.sum(), 1)).astype(x.dtype)

    def gradient(w: np.ndarray) -> np.ndarray:
        return ((sigmoid(x @ w) - target) * each) @ x + x.dtype.type(penalty) * w

    v = np.full(x.shape[1], 1 / np.sqrt(x.shape[1]), x.dtype)
    for _ in range(20):
        v = ((x @ v) * each) @ x
        size = max(float(np.linalg.norm(v)), 1e-12)
        v = v / x.dtype.type(size)
    return _descend(gradient, np.zeros(x.shape[1], x.dtype), 1 / (size / 4 + penalty), rounds).astype(x.dtype)


def support_vectors(
    features: np.ndarray, positive: np.ndarray, penalty: float = 1e-5, rounds: int = 300
) -> np.ndarray:
    """Weights of a linear support vector machine with squared hinge loss, the constant last."""
    x = _with_constant(features)
    y = np.where(positive, 1.0, -1.0).astype(x.dtype)

    def gradient(w: np.ndarray) -> np.ndarray:
        short = np.maximum(0, 1 - y * (x @ w))
        return -2 * x.T @ (short * y) / len(x) + penalty * w

    return _descend(gradient, np.zeros(x.shape[1], x.dtype), 1 / (2 * _norm(x) + penalty), rounds)


def platt(scores: np.ndarray, positive: np.ndarray, rounds: int = 500) -> tuple[float, float]:
    """Slope and constant that turn a score into a probability, with Platt's smoothed targets."""
    ones, zeros = positive.sum(), (~positive).sum()
    target = np.where(positive, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = max(float(np.abs(scores).max(initial=0)), 1e-9)
    x = np.stack([scores / scale, np.ones_like(scores)], axis=1)

    def gradient(w: np.ndarray) -> np.ndarray:
        return x.T @ (sigmoid(x @ w) - target) / max(len(x), 1)

    slope, constant = _descend(gradient, np.zeros(2), 4 / max(_norm(x), 1e-9), rounds)
    return float(slope / scale), float(constant)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
