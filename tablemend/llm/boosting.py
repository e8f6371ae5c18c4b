"""Small gradient-boosted trees: fitted in the driver on a bounded sample, scored as an SQL expression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 40
DEPTH = 3
RATE = 0.3
#: Split points tried for a feature.
CUTS = 24
LEAST_WEIGHT = 1.0
RIDGE = 1.0


@dataclass(frozen=True)
class Node:
    """A leaf with a value, or a question: is the feature at most ``cut``?"""

    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None


@dataclass(frozen=True)
class Trees:
    """Log-odds of the positive class: a start and a sum of trees."""

    start: float
    trees: tuple[Node, ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += _evaluate(tree, x)
        return out

    def column(self, features: list[Column]) -> Column:
        """The score as an expression over feature columns, the same as ``score`` gives."""
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + _column(tree, features)
        return total


def _evaluate(node: Node, x: np.ndarray) -> np.ndarray:
    if node.low is None:
        return np.full(len(x), node.value)
    return np.where(x[:, node.feature] <= node.cut, _evaluate(node.low, x), _evaluate(node.high, x))


def _column(node: Node, features: list[Column]) -> Column:
    if node.low is None:
        return F.lit(node.value)
    below = features[node.feature] <= F.lit(node.cut)
    return F.when(below, _column(node.low, features)).otherwise(_column(node.high, features))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH) -> Trees | None:
    """Trees on the gradients of the logistic loss. None if the sample has one class only."""
    if not len(y) or y.all() or not y.any():
        return None
    share = y.mean()
    start = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[:-1])) for f in range(x.shape[1])]
    score, trees = np.full(len(y), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, y - p, p * (1 - p), cuts, depth)
        trees.append(tree)
        score += _evaluate(tree, x)
    return Trees(start, tuple(trees))


def _grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, cuts: list[np.ndarray], depth: int) -> Node:
    leaf = Node(value=float(RATE * gradient.sum() / (weight.sum() + RIDGE)))
    if depth == 0 or weight.sum() < 2 * LEAST_WEIGHT:
        return leaf
    best, chosen = 1e-6, None
    whole = gradient.sum() ** 2 / (weight.sum() + RIDGE)
    for f, points in enumerate(cuts):
        slot = np.searchsorted(points, x[:, f], side="left")
        g = np.cumsum(np.bincount(slot, gradient, len(points) + 1))
        w = np.cumsum(np.bincount(slot, weight, len(points) + 1))
        low_g, low_w, high_g, high_w = g[:-1], w[:-1], g[-1] - g[:-1], w[-1] - w[:-1]
        gain = low_g**2 / (low_w + RIDGE) + high_g**2 / (high_w + RIDGE) - whole
        gain[(low_w < LEAST_WEIGHT) | (high_w < LEAST_WEIGHT)] = 0
        if len(gain) and gain.max() > best:
            best, chosen = gain.max(), (f, float(points[gain.argmax()]))
    if chosen is None:
        return leaf
    f, cut = chosen
    low = x[:, f] <= cut
    return Node(
        feature=f,
        cut=cut,
        low=_grow(x[low], gradient[low], weight[low], cuts, depth - 1),
        high=_grow(x[~low], gradient[~low], weight[~low], cuts, depth - 1),
    )


def threshold_for(score: np.ndarray, y: np.ndarray, precision: float, least: int) -> float:
    """The lowest score above which held-out rows are positive at the given precision; infinite if there is none.

    At least ``least`` rows must lie above it, and the precision counts one more row as wrong.
    """
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(y[order])
    n = np.arange(1, len(y) + 1)
    last_of_tie = np.append(score[order][1:] != score[order][:-1], True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero((right / (n + 1) >= precision) & (n >= least) & last_of_tie)
    return float(score[order][good[-1]]) if len(good) else float("inf")
