"""Logistic regression on a bounded sample of dense rows."""

from __future__ import annotations

import numpy as np


class Logistic:
    """Scaled features, weights of highest likelihood under a ridge penalty."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, weights

    @classmethod
    def fit(
        cls, rows: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 25
    ) -> Logistic:
        """``target`` may be a probability. Without rows the chance of both labels is even."""
        width = rows.shape[1]
        if not len(rows):
            return cls(np.zeros(width), np.ones(width), np.zeros(width + 1))
        mean, scale = rows.mean(axis=0), rows.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        x = np.column_stack([np.ones(len(rows)), (rows - mean) / scale])
        penalty = np.full(width + 1, ridge)
        penalty[0] = 1e-3
        w = np.zeros(width + 1)
        loss = np.inf
        step = 1.0
        for _ in range(rounds):  # Newton, halving steps that overshoot
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (target - p) - penalty * w
            curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
            move = np.linalg.solve(curvature, gradient)
            step = 1.0
            while step > 1e-3:
                trial = w + step * move
                z = np.clip(x @ trial, -30, 30)
                value = np.sum(np.logaddexp(0, z) - target * z) + (penalty * trial**2).sum() / 2
                if value <= loss:
                    break
                step /= 2
            done = loss - value < 1e-6
            w, loss = trial, value
            if done:
                break
        return cls(mean, scale, w)

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return self.weights[0] + ((rows - self.mean) / self.scale) @ self.weights[1:]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
