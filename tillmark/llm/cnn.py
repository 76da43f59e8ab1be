"""A small convolutional network over codes of one byte, trained and applied in numpy.

Filters of several widths slide over a fixed-length window, the largest value of each is kept, and
a softmax over their weighted sums gives the classes. The input is one-hot, so that a filter is a
table of a value per place and code, and applying it is looking up and adding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tillmark.llm.common import ship_by_value

AT_ONCE = 256


class ByteNetwork:
    """``classes`` scores for windows of codes 0 to 255; code 0 stands for no character."""

    def __init__(self, classes: int, widths: tuple[int, ...] = (2, 3, 4), filters: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.widths, self.filters = widths, filters
        self.tables = [rng.normal(0, 0.3 / w, (w, 256, filters)).astype(np.float32) for w in widths]
        self.bias = [np.zeros(filters, np.float32) for _ in widths]
        self.out = rng.normal(0, 0.1, (filters * len(widths), classes)).astype(np.float32)
        self.out_bias = np.zeros(classes, np.float32)
        self._pairs: list | None = None

    def _parameters(self) -> list[np.ndarray]:
        return [*self.tables, *self.bias, self.out, self.out_bias]

    def flat(self) -> np.ndarray:
        """All parameters in a row."""
        return np.concatenate([p.ravel() for p in self._parameters()])

    def set_flat(self, values: np.ndarray) -> None:
        """Takes parameters as ``flat`` gives them."""
        at = 0
        for p in self._parameters():
            p[...] = values[at: at + p.size].reshape(p.shape)
            at += p.size
        self._pairs = None

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest value of each filter, and where it is."""
        top, where = [], []
        for w, table, b in zip(self.widths, self.tables, self.bias, strict=True):
            span = x.shape[1] - w + 1
            value = table[0][x[:, :span]]
            for j in range(1, w):
                value = value + table[j][x[:, j: j + span]]
            at = value.argmax(1)
            where.append(at)
            top.append(np.maximum(np.take_along_axis(value, at[:, None, :], 1)[:, 0] + b, 0))
        return np.concatenate(top, 1), where

    def _quick_pooled(self, x: np.ndarray) -> np.ndarray:
        """The same for use: two neighbouring places looked up as one."""
        if self._pairs is None:
            self._pairs = [
                [(table[j][:, None, :] + table[j + 1][None, :, :]).reshape(-1, self.filters)
                 if j + 1 < w else table[j] for j in range(0, w, 2)]
                for w, table in zip(self.widths, self.tables, strict=True)]
        both = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        top = []
        for w, pairs, b in zip(self.widths, self._pairs, self.bias, strict=True):
            span = x.shape[1] - w + 1
            value = None
            for step, t in enumerate(pairs):
                j = 2 * step
                got = np.take(t, both[:, j: j + span] if j + 1 < w else x[:, j: j + span], axis=0)
                value = got if value is None else np.add(value, got, out=value)
            top.append(np.maximum(value.max(1) + b, 0))
        return np.concatenate(top, 1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        parts = [self._quick_pooled(x[i: i + AT_ONCE]) for i in range(0, len(x), AT_ONCE)]
        pooled = np.concatenate(parts) if parts else np.zeros((0, len(self.out)), np.float32)
        return pooled @ self.out + self.out_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.logits(x))

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01,
              weights: np.ndarray | None = None, seed: int = 11) -> ByteNetwork:
        """Adam on the cross-entropy; the gradient reaches a filter only where it was largest."""
        rng = np.random.default_rng(seed)
        weights = np.ones(len(x), np.float32) if weights is None else weights.astype(np.float32)
        first = [np.zeros_like(p) for p in self._parameters()]
        second = [np.zeros_like(p) for p in self._parameters()]
        step = 0
        for _ in range(epochs):
            for part in _shuffled(len(x), batch, rng):
                step += 1
                for p, g, m, v in zip(self._parameters(), self._gradients(x[part], y[part], weights[part]),
                                      first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        self._pairs = None
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        pooled, where = self._pooled(x)
        wrong = softmax(pooled @ self.out + self.out_bias)
        wrong[np.arange(len(y)), y] -= 1
        wrong *= (weight / weight.sum())[:, None]
        back = (wrong @ self.out.T) * (pooled > 0)
        tables, bias = [], []
        rows, cols = np.arange(len(x))[:, None], np.arange(self.filters)[None, :]
        for i, (w, at) in enumerate(zip(self.widths, where, strict=True)):
            own = back[:, i * self.filters: (i + 1) * self.filters]
            grad = np.zeros_like(self.tables[i])
            for j in range(w):
                np.add.at(grad[j], (x[rows, at + j], np.broadcast_to(cols, at.shape)), own)
            tables.append(grad)
            bias.append(own.sum(0))
        return [*tables, *bias, pooled.T @ wrong, wrong.sum(0)]


def _shuffled(n: int, batch: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    order = rng.permutation(n)
    for i in range(0, n, batch):
        yield order[i: i + batch]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


ship_by_value(__name__)
