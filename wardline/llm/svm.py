"""Linear hinge-loss fits on bounded samples, and the calibration of their margins."""

from __future__ import annotations

import numpy as np


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int,
                            cost: float = 1.0, rounds: int = 20, seed: int = 7, counts: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised hinge-loss fit.

    ``rows``: indices and values of each example; ``labels``: -1 or 1. One dual variable at a time is
    set to its best value within [0, cost]; the bias is a feature that is always 1. ``counts``: how often each example
    stands for, once if not given. Both classes weigh the same. With examples of
    one class only, or none, the weights are zero and the bias is that class.
    """
    if not len(rows) or len(set(labels.tolist())) < 2:
        return np.zeros(size), float(labels[0]) if len(rows) else 0.0
    counts = np.ones(len(rows)) if counts is None else counts
    total = {y: counts[labels == y].sum() for y in set(labels.tolist())}
    share = counts * counts.sum() / (2 * np.array([total[y] for y in labels.tolist()]))
    weights, bias, alpha = np.zeros(size), 0.0, np.zeros(len(rows))
    norms = np.array([float(v @ v) + 1.0 for _, v in rows])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, value = rows[i]
            gradient = labels[i] * (weights[at] @ value + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost * share[i])
            step = (new - alpha[i]) * labels[i]
            if step:
                weights[at] += step * value
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return weights, bias


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and offset of the logistic curve through margins (a column each) and labels (0 or 1), with
    smoothed targets."""
    margins = np.asarray(margins, float)
    margins = margins[:, None] if margins.ndim == 1 else margins
    if not len(labels):
        return np.zeros(margins.shape[1]), 0.0
    positive, negative = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.c_[margins, np.ones(len(labels))]
    b = np.zeros(x.shape[1])
    for _ in range(60):
        p = logistic(x @ b)
        w = p * (1 - p) + 1e-9
        step = np.linalg.solve((x * w[:, None]).T @ x + 1e-4 * np.eye(len(b)), x.T @ (p - target) + 1e-4 * b)
        b = b - min(1.0, 5.0 / max(1e-12, np.abs(step).max())) * step
        if np.abs(step).max() < 1e-8:
            break
    return b[:-1], float(b[-1])


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
