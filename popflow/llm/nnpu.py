"""Non-negative positive-unlabelled risk, minimised by a numpy linear model.

Risk of a scorer z with class prior p, logistic loss l, positives P and
unlabelled rows U:  p E_P[l(z)] + max(0, E_U[l(-z)] - p E_P[l(-z)]).
Where the second term falls below zero the step ascends it instead, so that a
flexible model cannot push the estimate under zero.

The class prior is estimated from positives and unlabelled rows alone: a model
that tells the two apart scores rows it was not fitted on, and the prior is the
ratio of the shares of unlabelled and of positive rows above a cut. Above a cut
that leaves no negatives the ratio is the prior; the cut of the least upper
confidence bound is taken.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class Rows:
    """0/1 rows held as the indices of their ones."""

    def __init__(self, ones: list[list[int]], dim: int):
        self.ones = ones
        self.n, self.dim = len(ones), dim
        self.row = np.repeat(np.arange(self.n), [len(x) for x in ones])
        self.ix = np.array([i for x in ones for i in x], np.int64)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.ix], self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        """Sum of ``values`` over the rows that have each one."""
        return np.bincount(self.ix, values[self.row], self.dim)


@dataclass
class LinearModel:
    weights: np.ndarray
    bias: float

    def proba(self, z: np.ndarray) -> np.ndarray:
        return sigmoid(z + self.bias)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> float:
    """Value of the non-negative risk for given scores."""
    rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    return float(prior * np.logaddexp(0, -zp).mean() + max(0.0, rest))


def _adam(gradient, dim: int, l2: float, updates: int, lr: float) -> LinearModel:
    """Adam with a cosine rate; ``gradient`` maps weights and bias to theirs."""
    theta = np.zeros(dim + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, updates + 1):
        grad = gradient(theta)
        grad[:-1] += l2 * theta[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        rate = lr * 0.5 * (1 + np.cos(np.pi * step / updates))
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return LinearModel(theta[:-1].copy(), float(theta[-1]))


def fit(xp: Rows, xu: Rows, prior: float, *, l2: float = 1e-3, updates: int = 600,
        lr: float = 0.05) -> LinearModel:
    """Least non-negative risk."""
    def gradient(theta):
        zp, zu = xp.dot(theta[:-1]) + theta[-1], xu.dot(theta[:-1]) + theta[-1]
        sp, su = sigmoid(zp) / xp.n, sigmoid(zu) / xu.n
        # d l(-z)/dz = s and d l(z)/dz = s - 1
        negative = np.append(xu.back(su), su.sum()) - prior * np.append(xp.back(sp), sp.sum())
        if np.logaddexp(0, zu).mean() >= prior * np.logaddexp(0, zp).mean():
            pull = sp - 1 / xp.n
            return prior * np.append(xp.back(pull), pull.sum()) + negative
        return -negative

    return _adam(gradient, xp.dim, l2, updates, lr)


def told_apart(xp: Rows, xu: Rows, l2: float, updates: int, lr: float = 0.05) -> LinearModel:
    """Logistic model of positives against unlabelled rows, both of equal weight."""
    def gradient(theta):
        gp = (sigmoid(xp.dot(theta[:-1]) + theta[-1]) - 1) / xp.n
        gu = sigmoid(xu.dot(theta[:-1]) + theta[-1]) / xu.n
        return np.append(xp.back(gp), gp.sum()) + np.append(xu.back(gu), gu.sum())

    return _adam(gradient, xp.dim, l2, updates, lr)


#: Chance that the confidence bound of a cut fails.
DOUBT = 0.1


def ratio_prior(zp: np.ndarray, zu: np.ndarray) -> float:
    """Share of positives among unlabelled rows, from scores of both."""
    cuts = np.unique(zp)
    above_p = 1 - np.searchsorted(np.sort(zp), cuts, "left") / len(zp)
    above_u = 1 - np.searchsorted(np.sort(zu), cuts, "left") / len(zu)
    slack = np.sqrt(np.log(4 / DOUBT) / 2) * (len(zp) ** -0.5 + len(zu) ** -0.5)
    at = int(np.argmin((above_u + slack) / above_p))
    return float(min(1.0, above_u[at] / above_p[at]))


def class_prior(xp: Rows, xu: Rows, half_p: np.ndarray, half_u: np.ndarray, *, l2: float, updates: int = 300) -> float:
    """The prior, from scores that a model of the other half of the rows gives.

    ``half_p`` and ``half_u`` deal the rows; a half without either kind has no
    model, its rows score zero.
    """
    zp, zu = np.zeros(xp.n), np.zeros(xu.n)

    def part(x: Rows, on: np.ndarray) -> Rows:
        return Rows([x.ones[i] for i in np.flatnonzero(on)], x.dim)

    for half in (False, True):
        fit_p, fit_u = part(xp, half_p != half), part(xu, half_u != half)
        if fit_p.n and fit_u.n:
            model = told_apart(fit_p, fit_u, l2, updates)
            zp[half_p == half] = part(xp, half_p == half).dot(model.weights) + model.bias
            zu[half_u == half] = part(xu, half_u == half).dot(model.weights) + model.bias
    return ratio_prior(zp, zu)


def best_cut(zp: np.ndarray, zu: np.ndarray, prior: float) -> float:
    """Score cut of least non-negative zero-one risk; the middle of its plateau."""
    cuts = np.unique(np.concatenate([zp, zu]))
    missed = np.searchsorted(np.sort(zp), cuts, "left") / len(zp)
    called = 1 - np.searchsorted(np.sort(zu), cuts, "left") / len(zu)
    value = prior * missed + np.maximum(0.0, called - prior * (1 - missed))
    at = int(np.flatnonzero(value <= value.min() + 1e-12)[-1])  # rows at or above this cut are called
    return float((cuts[at] + cuts[at - 1]) / 2) if at else float(cuts[0])


def calibrated(model: LinearModel, xp: Rows, xu: Rows, prior: float, at: float) -> LinearModel:
    """The model with its bias moved so that the best cut scores ``at``."""
    cut = best_cut(xp.dot(model.weights), xu.dot(model.weights), prior)
    return LinearModel(model.weights, float(np.log(at / (1 - at)) - cut))
