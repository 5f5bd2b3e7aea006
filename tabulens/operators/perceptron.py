"""A perceptron with one hidden layer, trained by gradient steps over all weighted rows.

Many networks (settings) of one shape are trained together: a step is one pass that sums the gradients of all of them; their weights and
the momenta stay on the driver. The loss is the mean log loss plus an l2 term on the weights (not the offsets). `sgd` uses Nesterov
momentum; its rate is constant, falls with the square root of the step ("invscaling"), or is divided by five when the loss has not
fallen for ten steps ("adaptive"). `adam` has the usual bias-corrected moments.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np

from tabulens.fixed_values import SEED
from tabulens.functions.blocks import Blocks

MOMENTUM, BETA_1, BETA_2, EPSILON = 0.9, 0.9, 0.999, 1e-8
ALPHA, STALE, LEAST_GAIN, LEAST_RATE = 1e-4, 10, 1e-4, 1e-6


@dataclass(frozen=True)
class Shape:
    features: int
    hidden: int
    labels: int
    activation: str = "relu"

    @property
    def outputs(self) -> int:
        return 1 if self.labels <= 2 else self.labels

    @property
    def size(self) -> int:
        return (self.features + 1) * self.hidden + (self.hidden + 1) * self.outputs

    def split(self, v: np.ndarray) -> tuple[np.ndarray, ...]:
        """Weights (settings, in, out) and offsets of both layers as views of (settings, size)."""
        d, h, o = self.features, self.hidden, self.outputs
        cuts = np.cumsum([d * h, h, h * o])
        a, b, c, e = np.split(v, cuts, axis=-1)
        return a.reshape(*v.shape[:-1], d, h), b, c.reshape(*v.shape[:-1], h, o), e

    def start(self, seed: int = SEED) -> np.ndarray:
        """Uniform weights, wider for fewer connections."""
        rng, factor = np.random.default_rng(seed), 2.0 if self.activation == "logistic" else 6.0
        out = []
        for n_in, n_out in ((self.features, self.hidden), (self.hidden, self.outputs)):
            bound = np.sqrt(factor / (n_in + n_out))
            out += [rng.uniform(-bound, bound, n_in * n_out), rng.uniform(-bound, bound, n_out)]
        return np.concatenate(out)

    def penalised(self) -> np.ndarray:
        """1 for weights, 0 for offsets."""
        mask = np.zeros(self.size)
        first, _, second, _ = self.split(mask)
        first[...], second[...] = 1, 1
        return mask


def _forward(shape: Shape, v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden values and output scores of one network."""
    w1, b1, w2, b2 = shape.split(v)
    hidden = x @ w1
    hidden += b1
    if shape.activation == "logistic":
        # in place, and without limits: an overflow ends in 0, as it should
        np.negative(hidden, out=hidden)
        with np.errstate(over="ignore"):
            np.exp(hidden, out=hidden)
        hidden += 1
        np.reciprocal(hidden, out=hidden)
    else:
        np.maximum(hidden, 0, out=hidden)
    return hidden, hidden @ w2 + b2


def _gradients(shape: Shape, networks: np.ndarray) -> Callable:
    """Per network: summed loss and summed gradient; the last value is the weight of the rows."""

    def run(x, y, w):
        out = np.zeros((len(networks), shape.size + 1))
        with np.errstate(over="ignore", invalid="ignore"):
            for row, v in zip(out, networks):
                if not np.isfinite(v).all():
                    row[:] = np.nan
                    continue
                hidden, z = _forward(shape, v, x)
                if shape.outputs == 1:
                    t = (y == 1)[:, None].astype(float)
                    row[0] = (w[:, None] * (np.logaddexp(0, z) - t * z)).sum()
                    delta = 1 / (1 + np.exp(-np.clip(z, -700, 700))) - t
                else:
                    z = z - z.max(1, keepdims=True)
                    log = z - np.log(np.exp(z).sum(1, keepdims=True))
                    t = (y[:, None] == np.arange(shape.outputs)).astype(float)
                    row[0] = -(w[:, None] * t * log).sum()
                    delta = np.exp(log) - t
                delta *= w[:, None]
                _, _, w2, _ = shape.split(v)
                g1, gb1, g2, gb2 = shape.split(row[1:])
                g2[...], gb2[...] = hidden.T @ delta, delta.sum(0)
                if shape.activation == "logistic":
                    slope = hidden * hidden
                    np.subtract(hidden, slope, out=slope)
                else:
                    slope = (hidden > 0).astype(float)
                if shape.outputs == 1:  # one output's weights are factors of the sums, not of every row
                    g1[...], gb1[...] = (x * delta).T @ slope * w2[:, 0], (delta.T @ slope)[0] * w2[:, 0]
                else:
                    slope *= delta @ w2.T
                    g1[...], gb1[...] = x.T @ slope, slope.sum(0)
        return np.append(out.ravel(), w.sum())

    return run


class Trainer:
    """Steps for settings (solver, schedule, rate), all from the same start; `after` is called with the number of steps done."""

    def __init__(self, blocks: Blocks, shape: Shape, settings: Sequence[tuple[str, str, float]], seed: int = SEED):
        self.blocks, self.shape = blocks, shape
        self.adam = np.array([s == "adam" for s, _, _ in settings])[:, None]
        self.kinds = [k for _, k, _ in settings]
        self.first = np.array([r for _, _, r in settings], float)
        self.rates = self.first.copy()
        self.networks = np.tile(shape.start(seed), (len(settings), 1))
        self.mean, self.square = np.zeros_like(self.networks), np.zeros_like(self.networks)
        self.best, self.stale = np.full(len(settings), np.inf), np.zeros(len(settings), int)
        self.losses = np.full(len(settings), np.nan)
        self.done, self._mask = 0, shape.penalised()

    def step(self) -> None:
        total = self.blocks.sum(_gradients(self.shape, self.networks))
        if not len(total):
            raise ValueError("no rows to learn from")
        n, table = total[-1], total[:-1].reshape(len(self.networks), -1)
        with np.errstate(over="ignore", invalid="ignore"):
            ridge = ALPHA / n * self._mask * self.networks
            self.losses = table[:, 0] / n + 0.5 * (ridge * self.networks).sum(1)
            grad = table[:, 1:] / n + ridge
            self.done += 1
            rate = self.rates[:, None]
            moved = MOMENTUM * self.mean - rate * grad
            sgd = MOMENTUM * moved - rate * grad
            mean, square = BETA_1 * self.mean + (1 - BETA_1) * grad, BETA_2 * self.square + (1 - BETA_2) * grad**2
            scale = rate * np.sqrt(1 - BETA_2**self.done) / (1 - BETA_1**self.done)
            self.networks = self.networks + np.where(self.adam, -scale * mean / (np.sqrt(square) + EPSILON), sgd)
            self.mean, self.square = np.where(self.adam, mean, moved), square
        self._schedule()

    def _schedule(self) -> None:
        for i, kind in enumerate(self.kinds):
            self.stale[i] = 0 if self.losses[i] < self.best[i] - LEAST_GAIN else self.stale[i] + 1
            self.best[i] = min(self.best[i], self.losses[i])
            if kind == "invscaling":
                self.rates[i] = self.first[i] / np.sqrt(self.done + 1)
            elif kind == "adaptive" and self.stale[i] > STALE and self.rates[i] > LEAST_RATE:
                self.rates[i] /= 5
                self.stale[i] = 0

    def run(self, steps: int) -> np.ndarray:
        """The weights after so many more steps."""
        for _ in range(steps):
            self.step()
        return self.networks


def predicted(shape: Shape, v: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Positions of the labels; -1 where the weights are no numbers."""
    if not np.isfinite(v).all():
        return np.full(len(x), -1)
    z = _forward(shape, v, x)[1]
    return (z[:, 0] > 0).astype(np.int64) if shape.outputs == 1 else z.argmax(1)
