"""Small logistic regressions on the driver, over bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 40,
                 times: np.ndarray | None = None) -> np.ndarray:
    """Weights and, last, the constant; targets may lie between 0 and 1, and
    a row stands for ``times`` equal ones.

    Newton steps, halved until the loss falls; the constant isn't shrunk.
    """
    a = np.hstack([x, np.ones((len(x), 1))])
    shrink = np.append(np.full(x.shape[1], ridge), 1e-6)
    w = np.zeros(a.shape[1])
    times = np.ones(len(a)) if times is None else times

    def loss(w):
        z = a @ w
        return (times * (np.logaddexp(0, z) - target * z)).sum() + 0.5 * (shrink * w * w).sum()

    now = loss(w)
    for _ in range(rounds):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (times * (p * (1 - p) + 1e-9))[:, None]).T @ a + np.diag(shrink),
                               a.T @ (times * (p - target)) + shrink * w)
        size = 1.0
        while loss(w - size * step) > now and size > 1e-4:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-8 * max(1.0, before):
            break
    return w
