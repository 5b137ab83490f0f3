"""Non-negative positive-unlabelled learning of linear classifiers in numpy.

The risk is prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1)) with the
logistic loss, over trusted positives and unlabelled rows. When the bracket goes
below zero, the step undoes it, which is what keeps a flexible model from
fitting the positives among the unlabelled rows as negatives.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Sparse binary rows: feature numbers of row i are index[at[i]:at[i + 1]]."""

    index: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, lists: list[np.ndarray]) -> Rows:
        at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        return cls(np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64), at)

    def __len__(self) -> int:
        return len(self.at) - 1

    def times(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.index])])
        return total[self.at[1:]] - total[self.at[:-1]]

    def transposed_times(self, values: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.index, np.repeat(values, np.diff(self.at)), n)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_nnpu(positive: Rows, unlabelled: Rows, n: int, prior: float, steps: int = 800, rate: float = 0.05, decay: float = 1e-5, least: float = -np.inf) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by full-batch Adam; no weight goes below `least`. Without rows on a side: zeros and the prior's log odds."""
    prior = float(np.clip(prior, 1e-4, 1 - 1e-4))
    w, b = np.zeros(n), float(np.log(prior / (1 - prior)))
    if not len(positive) or not len(unlabelled):
        return w, b
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1):
        zp, zu = positive.times(w) + b, unlabelled.times(w) + b
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # derivatives of the losses: softplus(-z) for positives, softplus(z) for the rest
        dp, du = -sigmoid(-zp) * prior / len(zp), np.zeros(len(zu))
        if negative >= 0:
            du = sigmoid(zu) / len(zu)
            dp = dp - prior * sigmoid(zp) / len(zp)
        else:
            du = -sigmoid(zu) / len(zu)
            dp = prior * sigmoid(zp) / len(zp)
        g = np.append(positive.transposed_times(dp, n) + unlabelled.transposed_times(du, n) + decay * w, dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = np.maximum(w - step[:-1], least), b - step[-1]
    return w, matched_bias(unlabelled.times(w), prior)


def matched_bias(margins: np.ndarray, prior: float) -> float:
    """The bias at which the unlabelled rows' mean probability is the prior; on small samples the clipped risk leaves it free."""
    low, high = -40.0, 40.0
    for _ in range(80):
        b = (low + high) / 2
        low, high = (b, high) if sigmoid(margins + b).mean() < prior else (low, b)
    return (low + high) / 2
