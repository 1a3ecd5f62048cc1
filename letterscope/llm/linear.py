"""Linear models fitted on bounded samples: squared-hinge and logistic, by accelerated gradient steps."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _steepest(x: np.ndarray) -> float:
    """The largest eigenvalue of x'x / n, by power iteration."""
    v = np.full(x.shape[1], 1.0, x.dtype) / np.sqrt(x.shape[1])
    size = 1.0
    for _ in range(12):
        v = x.T @ (x @ v)
        size = float(np.linalg.norm(v))
        if size == 0:
            return 1.0
        v = v / size
    return size / len(x)


def fit(x: np.ndarray, y: np.ndarray, loss: str, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and offset for labels ``y`` of -1 and 1; ``loss`` is ``hinge`` (squared) or ``logistic``."""
    one = np.ones((len(x), 1), x.dtype)
    wide = np.concatenate([x, one], axis=1)
    bend = 2.0 if loss == "hinge" else 0.25
    rate = 1.0 / (1.1 * bend * _steepest(wide) + penalty)
    w = ahead = np.zeros(wide.shape[1], x.dtype)
    keep = np.append(np.full(x.shape[1], penalty), 0.0).astype(x.dtype)
    for k in range(steps):
        margin = y * (wide @ ahead)
        pull = -2.0 * np.maximum(0.0, 1.0 - margin) if loss == "hinge" else -sigmoid(-margin)
        step = ahead - rate * (wide.T @ (pull * y).astype(x.dtype) / len(x) + keep * ahead)
        ahead = step + (k / (k + 3.0)) * (step - w)
        w = step
    return w[:-1].astype(float), float(w[-1])


def fit_among(x: np.ndarray, y: np.ndarray, among: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """As :func:`fit` with squared hinge on the rows where ``among`` holds, without copying rows or adding a column."""
    own, n = among.astype(x.dtype), float(among.sum())

    def products(u: np.ndarray) -> tuple[np.ndarray, float]:
        return x.T @ u / n, float(u.sum()) / n

    v, at_one, size = np.full(x.shape[1], 1.0, x.dtype), 1.0, 1.0
    length = np.sqrt(x.shape[1] + 1.0)
    v, at_one = v / length, at_one / length
    for _ in range(12):
        v, at_one = products((x @ v + at_one) * own)
        size = float(np.sqrt(v @ v + at_one * at_one))
        if size == 0:
            size = 1.0
            break
        v, at_one = v / size, at_one / size
    rate = 1.0 / (2.2 * size + penalty)
    w = ahead = np.zeros(x.shape[1], x.dtype)
    b = b_ahead = 0.0
    for k in range(steps):
        margin = y * (x @ ahead + b_ahead)
        slope, slope_one = products((-2.0 * np.maximum(0.0, 1.0 - margin) * y * own).astype(x.dtype))
        step, b_step = ahead - rate * (slope + penalty * ahead), b_ahead - rate * slope_one
        further = k / (k + 3.0)
        ahead, b_ahead = (step + further * (step - w)).astype(x.dtype), b_step + further * (b_step - b)
        w, b = step, b_step
    return w.astype(float), float(b)
