"""A small calibrated forest of decision trees in numpy, to be fitted on a bounded sample and applied inside tasks."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Forest:
    """Bagged trees on binned features, for any number of classes.

    The confidence of a prediction is the probability that the class with most votes is the right one, calibrated on
    out-of-bag rows by isotonic regression of that event on the share of votes.
    """

    trees: int = 24
    depth: int = 9
    bins: int = 32
    leaf: int = 3
    seed: int = 7
    classes: int = 0
    edges: list[np.ndarray] = field(default_factory=list)
    nodes: list[tuple[np.ndarray, ...]] = field(default_factory=list)
    knots: tuple[np.ndarray, np.ndarray] | None = None
    constant: int | None = None

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1).astype(np.int16)

    def _edges(self, column: np.ndarray) -> np.ndarray:
        """Edges between few values are exact, between many at quantiles."""
        values = np.unique(column)
        return values[1:] if len(values) <= self.bins else np.unique(np.quantile(column, np.linspace(0, 1, self.bins + 1)[1:-1]))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        """``x`` float features, ``y`` classes from 0 on. With rows of one class only, the forest predicts it; without rows, none (-1)."""
        self.nodes, self.knots, self.constant = [], None, None
        self.classes = int(y.max()) + 1 if len(y) else 0
        if len(np.unique(y)) < 2:
            self.constant = int(y[0]) if len(y) else -1
            return self
        self.edges = [self._edges(x[:, j]) for j in range(x.shape[1])]
        b, rng, n = self._binned(x), np.random.default_rng(self.seed), len(y)
        votes, seen = np.zeros((n, self.classes)), np.zeros(n, bool)
        for _ in range(self.trees):
            pick = rng.integers(0, n, n)
            tree = self._grow(b[pick], y[pick].astype(np.int64), rng)
            out = np.setdiff1d(np.arange(n), pick)
            votes[out] += self._apply(tree, b[out])
            seen[out] = True
            self.nodes.append(tree)
        votes = votes[seen] / np.maximum(votes[seen].sum(axis=1, keepdims=True), 1e-12)
        top = votes.argmax(axis=1)
        self.knots = _isotonic(votes[np.arange(len(top)), top], (top == y[seen]).astype(float))
        return self

    def _grow(self, b: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, split, left, value = [], [], [], []
        queue = [(np.arange(len(y)), 0)]
        width, at = max(len(e) for e in self.edges) + 1, 0
        while at < len(queue):
            rows, depth = queue[at]
            at += 1
            counts = np.bincount(y[rows], minlength=self.classes).astype(float)
            feature.append(-1), split.append(0), left.append(0), value.append(counts / counts.sum())
            if depth >= self.depth or len(rows) < 2 * self.leaf or counts.max() == len(rows):
                continue
            best = (1e-9, -1, 0)
            base = (counts**2).sum() / len(rows)
            for j in rng.permutation(b.shape[1])[: max(2, 2 * b.shape[1] // 3)]:
                n = np.bincount(b[rows, j] * np.int64(self.classes) + y[rows], minlength=width * self.classes).reshape(-1, self.classes)
                low = np.cumsum(n, axis=0)[:-1].astype(float)
                high = counts - low
                nl, nr = low.sum(axis=1), high.sum(axis=1)
                gain = np.where((nl >= self.leaf) & (nr >= self.leaf), (low**2).sum(axis=1) / np.maximum(nl, 1) + (high**2).sum(axis=1) / np.maximum(nr, 1) - base, 0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], j, k)
            if best[1] < 0:
                continue
            feature[-1], split[-1], left[-1] = best[1], best[2], len(queue)
            low_side = b[rows, best[1]] <= best[2]
            queue += [(rows[low_side], depth + 1), (rows[~low_side], depth + 1)]
        return np.array(feature), np.array(split), np.array(left), np.array(value)

    def _apply(self, tree: tuple[np.ndarray, ...], b: np.ndarray) -> np.ndarray:
        feature, split, left, value = tree
        node = np.zeros(len(b), int)
        for _ in range(self.depth):
            f = feature[node]
            go = f >= 0
            step = left[node] + (b[np.arange(len(b)), np.maximum(f, 0)] > split[node])
            node = np.where(go, step, node)
        return value[node]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class with most votes, its calibrated confidence, votes of all classes) of each row; class -1 and confidence 0 if nothing was learnt."""
        if self.knots is None or not len(x):
            constant = -1 if self.constant is None else self.constant
            votes = np.zeros((len(x), max(self.classes, 1)))
            if constant >= 0:
                votes[:, constant] = 1.0
            return np.full(len(x), constant), np.full(len(x), float(constant >= 0)), votes
        b = self._binned(x)
        votes = np.mean([self._apply(t, b) for t in self.nodes], axis=0)
        top = votes.argmax(axis=1)
        return top, np.interp(votes[np.arange(len(x)), top], *self.knots), votes


def _isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing step function of ``score`` nearest to ``y``, as knots to interpolate."""
    xs, at = np.unique(score, return_inverse=True)
    weight, total = np.bincount(at).astype(float), np.bincount(at, weights=y)
    blocks: list[list[float]] = []
    for x, w, s in zip(xs, weight, total, strict=True):
        blocks.append([x, x, w, s])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            _, hi, w2, s2 = blocks.pop()
            blocks[-1] = [blocks[-1][0], hi, blocks[-1][2] + w2, blocks[-1][3] + s2]
    return np.array([v for lo, hi, _, _ in blocks for v in (lo, hi)]), np.array([s / w for _, _, w, s in blocks for _ in (0, 1)])
