"""Logistic regression by Newton steps over weighted distinct rows; one run gives the weights after every number of steps.

The loss is the sum over all rows (constant C = 1), the intercept is penalised as the other weights are, and more than two labels are
fitted one against the rest. With the l2 penalty a step is the Newton step; with l1 it minimises the quadratic model plus the penalty by
coordinate sweeps and active sets on the driver (it needs the Hessian only). Both are shortened until the objective falls enough. A step costs two
passes: gradients and Hessians, then the losses of all step lengths at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from tabulens.functions.blocks import Blocks

#: Step lengths that are tried together.
LENGTHS = 0.5 ** np.arange(12)
#: A problem is solved when a step promises less than this share of the objective.
TOLERANCE = 1e-12


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def _targets(y: np.ndarray, problems: int) -> np.ndarray:
    """(rows, problems) of 0 and 1: two labels make one problem, more make one each."""
    return (y == 1)[:, None].astype(float) if problems == 1 else (y[:, None] == np.arange(problems)).astype(float)


def _losses(z: np.ndarray, t: np.ndarray, w: np.ndarray) -> np.ndarray:
    return w @ (np.logaddexp(0, z) - t * z)


def _slopes(weights: np.ndarray):
    problems, n = weights.shape

    def run(x, y, w):
        x, t = _with_one(x), _targets(y, problems)
        z = x @ weights.T
        p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
        grad = (w[:, None] * (p - t)).T @ x
        curve = w[:, None] * p * (1 - p)
        hess = np.stack([(x * curve[:, c, None]).T @ x for c in range(problems)])
        return np.concatenate([_losses(z, t, w), grad.ravel(), hess.ravel()])

    return run, lambda v: (v[:problems], v[problems : problems * (n + 1)].reshape(problems, n), v[problems * (n + 1) :].reshape(problems, n, n))


def _losses_along(weights: np.ndarray, steps: np.ndarray):
    problems = len(weights)

    def run(x, y, w):
        x, t = _with_one(x), _targets(y, problems)
        z, dz = x @ weights.T, x @ steps.T
        return np.concatenate([_losses(z + s * dz, t, w) for s in LENGTHS])

    return run


def _penalty(weights: np.ndarray, kind: str) -> np.ndarray:
    return np.abs(weights).sum(-1) if kind == "l1" else 0.5 * (weights**2).sum(-1)


def _least_with_l1(curve: np.ndarray, grad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The u that minimises (u - w) @ curve @ (u - w) / 2 + grad @ u + sum(abs(u)).

    A sweep over the coordinates lets zeros leave; then the others go to the minimum of their signs' face, or as far as the first that
    becomes zero.
    """
    u, b = w.copy(), grad - curve @ w
    for _ in range(500):
        for j in range(len(u)):
            pull = b[j] + curve[j] @ u - curve[j, j] * u[j]
            u[j] = -np.sign(pull) * max(abs(pull) - 1.0, 0.0) / curve[j, j]
        some = np.flatnonzero(u)
        if len(some):
            sign = np.sign(u[some])
            way = np.linalg.solve(curve[np.ix_(some, some)], -(b[some] + sign)) - u[some]
            with np.errstate(divide="ignore"):
                until = np.where(np.sign(u[some] + way) != sign, -u[some] / np.where(way == 0, np.inf, way), np.inf)
            far = min(1.0, until.min())
            u[some] = np.where(until <= far, 0.0, u[some] + far * way)
        slope = curve @ u + b
        off = np.where(u != 0, np.abs(slope + np.sign(u)), np.maximum(np.abs(slope) - 1, 0))
        if off.max() <= 1e-9 * (1 + np.abs(b).max()):
            break
    return u


def _direction(w: np.ndarray, grad: np.ndarray, hess: np.ndarray, kind: str) -> tuple[np.ndarray, float]:
    """The step of one problem and the fall of the objective that its slope promises."""
    n = len(w)
    if kind == "l2":
        slope = grad + w
        step = -np.linalg.solve(hess + np.eye(n), slope)
        return step, float(slope @ step)
    new = _least_with_l1(hess + 1e-10 * (1 + np.trace(hess) / n) * np.eye(n), grad, w)
    step = new - w
    return step, float(grad @ step + np.abs(w + step).sum() - np.abs(w).sum())


@dataclass
class LogisticPath:
    """weights[i]: (problems, features + 1), the intercept last, after i steps; steps beyond the last change nothing."""

    labels: list
    weights: list[np.ndarray]

    def after(self, steps: int) -> np.ndarray:
        return self.weights[min(steps, len(self.weights) - 1)]


def fit_path(blocks: Blocks, labels: Sequence, penalty: str, max_iter: int) -> LogisticPath:
    if penalty not in ("l1", "l2"):
        raise ValueError("the penalty is l1 or l2")
    problems = 1 if len(labels) <= 2 else len(labels)
    weights = np.zeros((problems, blocks.width + 1))
    path = LogisticPath(list(labels), [weights])
    for _ in range(max_iter):
        run, parts = _slopes(weights)
        total = blocks.sum(run)
        if not len(total):
            raise ValueError("no rows to learn from")
        loss, grad, hess = parts(total)
        value = loss + _penalty(weights, penalty)
        steps, falls = map(np.array, zip(*[_direction(*x, penalty) for x in zip(weights, grad, hess)]))
        steps[-falls <= TOLERANCE * (1 + value)] = 0
        if not steps.any():
            break
        tried = blocks.sum(_losses_along(weights, steps)).reshape(len(LENGTHS), problems)
        tried += np.stack([_penalty(weights + s * steps, penalty) for s in LENGTHS])
        enough = tried <= value + 0.01 * LENGTHS[:, None] * falls
        # no length helps: rounding has the last word
        length = np.where(enough.any(0), LENGTHS[enough.argmax(0)], 0.0)
        if not (steps * length[:, None]).any():
            break
        weights = weights + length[:, None] * steps
        path.weights.append(weights)
    return path


def predicted(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Positions of the labels; ties go to the first label."""
    z = _with_one(x) @ weights.T
    return (z[:, 0] > 0).astype(np.int64) if z.shape[1] == 1 else z.argmax(1)
