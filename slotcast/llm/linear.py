"""Logistic regression by accelerated gradient descent, for training sets of bounded rows held by one task."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(x, y, weight=None, steps: int = 300, l2: float = 1e-5):
    """Weights (features, outputs) and intercepts of one logistic regression per column of 0/1 ``y``.

    The step is the inverse of a bound on the curvature, so the loss goes down whatever the
    scale of the features; frequent features learn first, which is what keeps few rows from
    being learned by heart. Rows of weight 0 teach nothing.
    """
    x = np.asarray(x, np.float32)
    y = np.asarray(y, np.float32)
    share = np.full((len(x), 1), 1.0 / len(x), np.float32) if weight is None else np.asarray(weight, np.float32)
    rate = 1.0 / (0.25 * float((share[:, 0] * (np.einsum("ij,ij->i", x, x) + 1)).sum()) + l2)
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    ahead_w, ahead_b = w, b
    for t in range(1, steps + 1):
        error = (sigmoid(x @ ahead_w + ahead_b) - y) * share
        next_w = ahead_w - rate * (x.T @ error + l2 * ahead_w)
        next_b = ahead_b - rate * error.sum(0)
        push = (t - 1) / (t + 2)
        ahead_w, ahead_b = next_w + push * (next_w - w), next_b + push * (next_b - b)
        w, b = next_w, next_b
    return w, b


def platt(margin, y, steps: int = 300):
    """Slope and intercept of the sigmoid that turns margins into probabilities.

    Targets are smoothed towards one half by the class counts, so few rows never give
    certainty; Newton steps with a floor on the slope keep the order of the margins.
    """
    margin, y = np.asarray(margin, float), np.asarray(y, float)
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(float(np.abs(margin).max(initial=0.0)), 1e-9)
    z, a, b = margin / scale, 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * z + b)
        g, h = p - target, p * (1 - p) + 1e-9
        gradient = np.array([(g * z).sum(), g.sum()])
        hessian = np.array([[(h * z * z).sum(), (h * z).sum()], [(h * z).sum(), h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        a, b = max(a - step[0], 1e-3), b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return a / scale, b
