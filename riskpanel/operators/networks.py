"""Softmax regression and multilayer perceptrons, all settings of a grid fitted together.

Losses and gradients of every setting are one sum over the rows, so an iteration is one pass,
however many settings there are. Each setting runs its own L-BFGS with backtracking: with
every pass it submits one point and goes on with what it gets, until its loss no longer falls.
Class weights and the L2 penalty are part of the loss. Without hidden layers the network is a
multinomial logistic regression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .passes import Pass, ProbabilityModel, matrix, softmax, training_rows

CLASSES = 3
_MEMORY = 10
_ARMIJO = 1e-4
_HALVINGS = 20


def _shapes(layers: Sequence[int]) -> list[tuple[int, int]]:
    return [(a + 1, b) for a, b in zip(layers[:-1], layers[1:], strict=True)]  # the last row is the bias


def _weights(flat: np.ndarray, layers: Sequence[int]) -> list[np.ndarray]:
    out, at = [], 0
    for rows, columns in _shapes(layers):
        out.append(flat[at : at + rows * columns].reshape(rows, columns))
        at += rows * columns
    return out


def forward(x: np.ndarray, weights: list[np.ndarray]) -> list[np.ndarray]:
    """Activations of every layer, the last ones being class margins."""
    out = [x]
    for i, w in enumerate(weights):
        z = out[-1] @ w[:-1] + w[-1]
        out.append(z if i + 1 == len(weights) else np.maximum(z, 0.0))
    return out


def loss_and_gradient(x: np.ndarray, label: np.ndarray, weight: np.ndarray, flat: np.ndarray, layers: Sequence[int]) -> np.ndarray:
    """Weighted cross-entropy, then its gradient, summed over rows."""
    weights = _weights(flat, layers)
    layer = forward(x, weights)
    p = softmax(layer[-1])
    rows = np.arange(len(x))
    loss = -(weight * np.log(np.maximum(p[rows, label], 1e-300))).sum()
    delta = p
    delta[rows, label] -= 1
    delta *= weight[:, None]
    gradients = []
    for i in range(len(weights) - 1, -1, -1):
        gradients.append(np.vstack([layer[i].T @ delta, delta.sum(axis=0)]).ravel())
        if i:
            delta = (delta @ weights[i][:-1].T) * (layer[i] > 0)
    return np.concatenate([[loss], *gradients[::-1]])


@dataclass
class NetworkModel(ProbabilityModel):
    """A network over standardised features."""

    features: tuple[str, ...]
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[int, ...]
    flat: np.ndarray
    iterations: int = 0

    def predict(self, x: np.ndarray) -> np.ndarray:
        return softmax(forward((x - self.mean) / self.scale, _weights(self.flat, self.layers))[-1])

    def settings(self) -> dict:
        arrays = {n: getattr(self, n).tolist() for n in ("mean", "scale", "flat")}
        return {"features": list(self.features), "layers": list(self.layers), "iterations": self.iterations, **arrays}

    @classmethod
    def from_settings(cls, s: dict) -> NetworkModel:
        mean, scale, flat = (np.array(s[n], float) for n in ("mean", "scale", "flat"))
        return cls(tuple(s["features"]), mean, scale, tuple(s["layers"]), flat, s["iterations"])


class _Descent:
    """L-BFGS of one setting; ``point`` is where it wants loss and gradient next."""

    def __init__(self, start: np.ndarray, decay: np.ndarray, tolerance: float, patience: int):
        self.x, self.point, self.decay = start, start, decay
        self.loss = self.gradient = None
        self.tolerance, self.patience = tolerance, patience
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []
        self.history: list[float] = []
        self.halved, self.done, self.iterations = 0, False, 0

    def _direction(self) -> np.ndarray:
        q = self.gradient.copy()
        used = []
        for s, y in reversed(self.steps):
            a = (s @ q) / (y @ s)
            q -= a * y
            used.append(a)
        if self.steps:
            s, y = self.steps[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, y), a in zip(self.steps, reversed(used), strict=True):
            q += s * (a - (y @ q) / (y @ s))
        return -q

    def take(self, loss: float, gradient: np.ndarray) -> None:
        """Goes on from the mean loss and gradient at ``point``."""
        loss = loss + 0.5 * float((self.decay * self.point**2).sum())
        gradient = gradient + self.decay * self.point
        if self.loss is not None and not loss <= self.loss + _ARMIJO * self.step * self.slope:
            self.halved += 1
            self.step *= 0.5
            if self.halved < _HALVINGS:
                self.point = self.x + self.step * self.along
            elif self.steps:  # start again along the gradient
                self.steps = []
                self._go()
            else:
                self.done = True
            return
        if self.loss is not None:
            s, y = self.point - self.x, gradient - self.gradient
            if s @ y > 1e-10 * (y @ y):
                self.steps = [*self.steps[-_MEMORY + 1 :], (s, y)]
            self.iterations += 1
        self.x, self.loss, self.gradient = self.point, loss, gradient
        self.history.append(loss)
        flat = len(self.history) > self.patience and self.history[-1 - self.patience] - loss < self.tolerance * max(1.0, abs(loss))
        if flat or np.abs(gradient).max(initial=0.0) < 1e-8:
            self.done = True
        else:
            self._go()

    def _go(self) -> None:
        self.halved, self.step, self.along = 0, 1.0, self._direction()
        self.slope = float(self.gradient @ self.along)
        if self.slope >= 0:
            self.steps, self.along = [], -self.gradient
            self.slope = float(self.gradient @ self.along)
        self.point = self.x + self.along


def _start(layers: Sequence[int], seed: int) -> np.ndarray:
    """Small random weights, no biases; zero for a network without hidden layers."""
    generator, out = np.random.default_rng(seed), []
    for rows, columns in _shapes(layers):
        bound = np.sqrt(6.0 / (rows - 1 + columns)) if len(layers) > 2 else 0.0
        w = generator.uniform(-bound, bound, (rows, columns)) if bound else np.zeros((rows, columns))
        w[-1] = 0.0
        out.append(w.ravel())
    return np.concatenate(out)


def _penalised(layers: Sequence[int], l2: float) -> np.ndarray:
    """The penalty of each weight: none for biases."""
    out = []
    for rows, columns in _shapes(layers):
        w = np.full((rows, columns), l2)
        w[-1] = 0.0
        out.append(w.ravel())
    return np.concatenate(out)


def fit_networks(
    rows: DataFrame,
    features: Sequence[str],
    grid: Sequence[dict],
    *,
    max_iter: int,
    tolerance: float = 1e-5,
    patience: int = 10,
    seed: int = 42,
) -> list[NetworkModel]:
    """One model per setting (``hidden`` layer sizes, ``l2`` per unit of the mean loss), fitted on weighted rows.

    ``rows`` has the features, ``label`` 0 to 2 and ``weight``, and is best cached. The
    features are standardised with the mean and deviation of the rows. A setting ends after
    ``max_iter`` steps, or when ``patience`` of them lower its loss by less than
    ``tolerance``, as a share of it or absolutely if it is below one.
    """
    d = len(features)
    table = training_rows(rows, features)
    passes = Pass(table)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("x"), d)
        return np.concatenate([[len(x), batch.column("weight").to_numpy().sum()], x.sum(axis=0), (x**2).sum(axis=0)])

    found = passes.total(moments, 2 + 2 * d)
    n, total = max(found[0], 1.0), max(found[1], 1e-12)
    mean = found[2 : 2 + d] / n
    scale = np.sqrt(np.maximum(found[2 + d :] / n - mean**2, 0.0))
    scale[scale < 1e-12] = 1.0
    layers = [(d, *c["hidden"], CLASSES) for c in grid]
    runs = [_Descent(_start(shape, seed), _penalised(shape, c["l2"]), tolerance, patience) for shape, c in zip(layers, grid, strict=True)]
    context = rows.sparkSession.sparkContext
    while active := [i for i, r in enumerate(runs) if not r.done and r.iterations < max_iter]:
        sent = context.broadcast([(layers[i], runs[i].point) for i in active])
        sizes = [1 + len(runs[i].point) for i in active]

        def of(batch: pa.RecordBatch, sent=sent) -> np.ndarray:
            x = (matrix(batch.column("x"), d) - mean) / scale
            label, weight = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
            return np.concatenate([loss_and_gradient(x, label, weight, point, shape) for shape, point in sent.value])

        sums = np.split(passes.total(of, sum(sizes)) / total, np.cumsum(sizes)[:-1])
        sent.unpersist()
        for i, part in zip(active, sums, strict=True):
            runs[i].take(float(part[0]), part[1:])
    passes.release()
    return [NetworkModel(tuple(features), mean, scale, tuple(shape), r.x, r.iterations) for shape, r in zip(layers, runs, strict=True)]
