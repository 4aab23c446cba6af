"""Penalised logistic regression on a bounded sample, by limited-memory quasi-Newton steps."""

from collections import deque
from collections.abc import Callable

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class Sparse:
    """Rows of present features (ids), followed by dense columns; both ways of multiplication."""

    def __init__(self, rows: list[list[int]], width: int, dense: np.ndarray | None = None):
        self.n, self.width = len(rows), width
        self.at = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.ids = np.fromiter((i for r in rows for i in r), np.int64, len(self.at))
        self.dense = np.empty((self.n, 0)) if dense is None else dense
        self.size = width + self.dense.shape[1]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, w[self.ids], self.n) + self.dense @ w[self.width :]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate((np.bincount(self.ids, r[self.at], self.width), self.dense.T @ r))


def fit(x: Sparse, y: np.ndarray, penalty: float, weight: np.ndarray | None = None, steps: int = 120) -> np.ndarray:
    """Weights and, last, the intercept, which is not penalised. One class alone gives a constant."""
    weight = np.ones(len(y)) if weight is None else weight
    total = max(weight.sum(), 1e-12)
    base = float(np.clip((weight @ y) / total, 1e-4, 1 - 1e-4))
    start = np.append(np.zeros(x.size), np.log(base / (1 - base)))
    if not 0 < weight @ y < total:
        return start

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x.times(w[:-1]) + w[-1]
        r = weight * (sigmoid(z) - y) / total
        loss = (weight @ np.logaddexp(0, np.where(y > 0.5, -z, z))) / total + penalty / 2 * (w[:-1] @ w[:-1])
        return loss, np.append(x.back(r) + penalty * w[:-1], r.sum())

    return minimise(value, start, steps)


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], w: np.ndarray, steps: int) -> np.ndarray:
    past: deque = deque(maxlen=10)
    loss, slope = value(w)
    for _ in range(steps):
        if np.abs(slope).max() < 1e-6:
            break
        step, factors = slope.copy(), []
        for s, t, rho in reversed(past):
            factors.append(rho * (s @ step))
            step -= factors[-1] * t
        if past:
            s, t, _ = past[-1]
            step *= (s @ t) / (t @ t)
        for (s, t, rho), factor in zip(past, reversed(factors)):
            step += (factor - rho * (t @ step)) * s
        length, descent = 1.0, slope @ step
        while True:
            moved = w - length * step
            new_loss, new_slope = value(moved)
            if new_loss <= loss - 1e-4 * length * descent or length < 1e-8:
                break
            length /= 2
        s, t = moved - w, new_slope - slope
        if s @ t > 1e-14:
            past.append((s, t, 1 / (s @ t)))
        if loss - new_loss < 1e-10:
            return moved
        w, loss, slope = moved, new_loss, new_slope
    return w
