"""Sparse rows on the driver, and the training of models that are linear in them or in pairs of them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Row i has ``indices[starts[i]:starts[i + 1]]`` with the same slice of ``values``."""

    starts: np.ndarray
    indices: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, pairs: list[tuple[list[int], list[float]]]) -> Rows:
        starts = np.zeros(len(pairs) + 1, dtype=np.int64)
        np.cumsum([len(i) for i, _ in pairs], out=starts[1:])
        return cls(
            starts,
            np.fromiter((x for i, _ in pairs for x in i), np.int64, starts[-1]),
            np.fromiter((x for _, v in pairs for x in v), np.float64, starts[-1]),
        )

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Rows:
        lengths = self.starts[rows + 1] - self.starts[rows]
        starts = np.zeros(len(rows) + 1, dtype=np.int64)
        np.cumsum(lengths, out=starts[1:])
        at = np.arange(starts[-1]) + np.repeat(self.starts[rows] - starts[:-1], lengths)
        return Rows(starts, self.indices[at], self.values[at])

    def sums(self, per_entry: np.ndarray) -> np.ndarray:
        """``per_entry`` summed over the entries of each row."""
        total = np.zeros((len(per_entry) + 1, *per_entry.shape[1:]))
        np.cumsum(per_entry, axis=0, out=total[1:])
        return total[self.starts[1:]] - total[self.starts[:-1]]


@dataclass
class Model:
    """score = sigmoid(bias + w x + the sum over pairs of <v_i, v_j> x_i x_j); without factors it is linear."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, rows: Rows) -> np.ndarray:
        """By the sum-of-squares identity: half of (sum v x)^2 - sum (v x)^2, linear in the entries."""
        linear = rows.sums(self.weights[rows.indices] * rows.values)
        if not self.factors.shape[1]:
            return self.bias + linear
        entries = self.factors[rows.indices] * rows.values[:, None]
        return self.bias + linear + 0.5 * (rows.sums(entries) ** 2 - rows.sums(entries**2)).sum(axis=1)

    def score(self, rows: Rows) -> np.ndarray:
        return sigmoid(self.raw(rows))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: Rows, labels: np.ndarray, size: int, rank: int, epochs: int = 8, rate: float = 0.1, decay: float = 1e-4, batch: int = 128, least_steps: int = 600) -> Model:
    """Logistic loss by mini-batches with per-weight step sizes, at least ``least_steps`` of them; the same input gives the same model."""
    random = np.random.default_rng(7)
    share = np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99)
    model = Model(float(np.log(share / (1 - share))), np.zeros(size), random.normal(0, 0.05, (size, rank)))
    seen_w, seen_v, seen_b = np.full(size, 1e-4), np.full((size, rank), 1e-2), 1e-2
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(model.bias, model.weights, np.zeros((size, rank)))
    batches = max(1, len(labels) // batch)
    for _ in range(max(epochs, -(-least_steps // batches))):
        for at in np.array_split(random.permutation(len(labels)), batches):
            part = rows.take(at)
            error = (model.score(part) - labels[at]) / len(at)
            entry_error = np.repeat(error, np.diff(part.starts))
            used, where = np.unique(part.indices, return_inverse=True)
            gradient = np.bincount(where, entry_error * part.values, len(used)) + decay * model.weights[used] / len(at)
            if rank:
                entries = model.factors[part.indices] * part.values[:, None]
                rest = np.repeat(part.sums(entries), np.diff(part.starts), axis=0) - entries
                pulls = (entry_error * part.values)[:, None] * rest
                by = np.stack([np.bincount(where, pulls[:, f], len(used)) for f in range(rank)], axis=1) + decay * model.factors[used] / len(at)
                seen_v[used] += by**2
                model.factors[used] -= 0.5 * rate * by / np.sqrt(seen_v[used])
            seen_w[used] += gradient**2
            model.weights[used] -= rate * gradient / np.sqrt(seen_w[used])
            seen_b += error.sum() ** 2
            model.bias -= rate * error.sum() / np.sqrt(seen_b)
    return model
