"""Gradient boosted trees for small tables of numbers: logistic loss, Newton leaves."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

TREES = 80
DEPTH = 4
RATE = 0.3
LEAST_WEIGHT = 1.0  # of the second derivative in a leaf
BINS = 32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Tree:
    """A full binary tree: split feature and limit per inner node, a value per leaf."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            right = x[np.arange(len(x)), self.feature[node]] > self.limit[node]
            node = 2 * node + 1 + right
        return self.value[node - (2**DEPTH - 1)]


def _best_split(x, edges, gradient, weight) -> tuple[int, float]:
    """The feature and limit that lower the loss most; feature 0 above all if none does."""
    total_g, total_w = gradient.sum(), weight.sum()
    best, choice = 1e-9 + total_g**2 / (total_w + 1.0), (0, np.inf)
    for f, limits in enumerate(edges):
        if not len(limits):
            continue
        place = np.searchsorted(limits, x[:, f], side="left")
        left_g = np.cumsum(np.bincount(place, gradient, len(limits) + 1))[:-1]
        left_w = np.cumsum(np.bincount(place, weight, len(limits) + 1))[:-1]
        right_g, right_w = total_g - left_g, total_w - left_w
        gain = left_g**2 / (left_w + 1.0) + right_g**2 / (right_w + 1.0)
        gain[(left_w < LEAST_WEIGHT) | (right_w < LEAST_WEIGHT)] = -1
        at = int(np.argmax(gain))
        if gain[at] > best:
            best, choice = gain[at], (f, float(limits[at]))
    return choice


def _grow(x, edges, gradient, weight) -> Tree:
    feature = np.zeros(2**DEPTH - 1, np.int64)
    limit = np.full(2**DEPTH - 1, np.inf)
    node = np.zeros(len(x), np.int64)
    for inner in range(2**DEPTH - 1):
        inside = np.flatnonzero(node == inner)
        if len(inside):
            feature[inner], limit[inner] = _best_split(
                x[inside], edges, gradient[inside], weight[inside]
            )
        right = x[inside, feature[inner]] > limit[inner]
        node[inside] = 2 * inner + 1 + right
    leaf = node - (2**DEPTH - 1)
    g = np.bincount(leaf, gradient, 2**DEPTH)
    w = np.bincount(leaf, weight, 2**DEPTH)
    return Tree(feature, limit, -RATE * g / (w + 1.0))


@dataclass
class Booster:
    """Boosted trees and the calibration of their sum to a probability."""

    trees: list[Tree] = field(default_factory=list)
    start: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for tree in self.trees:
            total += tree(x)
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.raw(x))

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * raw + self.shift)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt's scaling on rows that the trees weren't grown on, by Newton's method."""
        self.calibrate_scores(self.raw(x), y, np.ones(len(y)))

    def calibrate_scores(self, raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        right = (weight * y).sum()
        positive = (right + 1) / (right + 2)
        target = np.where(y == 1, positive, 1 / (weight.sum() - right + 2))
        a, b = 1.0, 0.0
        for _ in range(25):
            p = sigmoid(a * raw + b)
            w = weight * (p * (1 - p) + 1e-9)
            g = np.array([(weight * (p - target) * raw).sum(), (weight * (p - target)).sum()])
            h = np.array([[(w * raw * raw).sum(), (w * raw).sum()], [(w * raw).sum(), w.sum()]])
            a, b = np.array([a, b]) - np.linalg.solve(h + 1e-3 * np.eye(2), g)
        self.slope, self.shift = float(max(a, 1e-3)), float(b)


def fit(x: np.ndarray, y: np.ndarray) -> Booster:
    share = np.clip(y.mean(), 0.01, 0.99)
    model = Booster(start=float(np.log(share / (1 - share))))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    total = np.full(len(x), model.start)
    for _ in range(TREES):
        p = sigmoid(total)
        tree = _grow(x, edges, p - y, p * (1 - p))
        model.trees.append(tree)
        total += tree(x)
    return model
