"""Regression trees of one series and window, grown level by level.

All trees of a forest grow at once: a sample is a (tree, row) pair with the number of times the tree drew the row, and a level costs a few array
operations over all samples and features, not a loop over nodes. Cuts are exact: every place between two different values of a
feature is tried, and the cut that lowers the squared error most wins (ties: the first feature, then the lowest value).

These run inside (series, window) groups, whose size the geometry of a backtest fixes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEED = 42
SMALLEST_ERROR = 1e-9


@dataclass
class Trees:
    """Nodes of all trees: feature (-1 in a leaf), cut, first of two children, mean; tree t starts at node t."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    mean: np.ndarray
    count: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Means of the leaves that rows fall into, one column per tree."""
        node = np.tile(np.arange(self.count), (len(x), 1))
        row = np.arange(len(x))[:, None]
        while (self.feature[node] >= 0).any():
            inner = self.feature[node] >= 0
            right = x[row, np.maximum(self.feature[node], 0)] > self.cut[node]
            node = np.where(inner, self.child[node] + right, node)
        return self.mean[node]


def _sums(node: np.ndarray, first: int, size: int, *values: np.ndarray) -> list[np.ndarray]:
    return [np.bincount(node - first, v, size) for v in values]


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int) -> tuple[Trees, np.ndarray]:
    """Trees for the weights (trees by rows: how often a tree drew a row), and the leaf of each (tree, row) with a weight, -1 without one."""
    count, rows = weight.shape
    tree, row = np.nonzero(weight)
    w, target = weight[tree, row].astype(float), y[row]
    rank = np.stack([np.unique(column, return_inverse=True)[1] for column in x.T]) if x.shape[1] else np.empty((0, len(x)), int)
    values = [np.unique(column) for column in x.T]
    node = tree.copy()
    leaf = np.full(weight.shape, -1)
    parts = []  # (feature, cut, child, mean) of each level's nodes
    first, size = 0, count
    for level in range(depth + 1):
        n, s, q = _sums(node, first, size, w, w * target, w * target * target)
        mean = s / np.maximum(n, 1)
        feature, cut, child = np.full(size, -1), np.zeros(size), np.zeros(size, int)
        wide = (q / np.maximum(n, 1) - mean**2 > SMALLEST_ERROR * np.maximum(1.0, mean**2)) & (level < depth) & (x.shape[1] > 0)
        open_ = wide[node - first]
        leaf[tree[~open_], row[~open_]] = node[~open_]
        tree, row, w, target, node = tree[open_], row[open_], w[open_], target[open_], node[open_]
        if len(node):
            best, where, above = _best_cuts(node - first, size, rank[:, row], w, target, np.where(wide, n, 0), np.where(wide, s, 0))
            split = wide & (best >= 0)
            feature[split] = best[split]
            cut[split] = [(values[f][low] + values[f][high]) / 2 for f, low, high in zip(best[split], where[split], above[split], strict=True)]
            child[split] = first + size + 2 * np.arange(split.sum())
            stays = ~split[node - first]  # all rows of the node are alike
            leaf[tree[stays], row[stays]] = node[stays]
            tree, row, w, target, node = tree[~stays], row[~stays], w[~stays], target[~stays], node[~stays]
            here = node - first
            right = rank[feature[here], row] > where[here]
            node = child[here] + right
        parts.append((feature, cut, child, mean))
        first, size = first + size, 2 * int((feature >= 0).sum())
        if not size:
            break
    return Trees(*[np.concatenate(p) for p in zip(*parts, strict=True)], count), leaf


def _best_cuts(node: np.ndarray, size: int, rank: np.ndarray, w: np.ndarray, target: np.ndarray, n: np.ndarray, s: np.ndarray):
    """(feature, ranks of the last value on the left and the first on the right) of each node's best cut; feature -1 where no feature has two values."""
    features, samples = rank.shape
    order = np.argsort(node * (int(rank.max()) + 1) + rank, axis=1, kind="stable")
    nodes = node[order]
    ranks = np.take_along_axis(rank, order, axis=1)
    left_n, left_s = np.cumsum(w[order], axis=1), np.cumsum((w * target)[order], axis=1)
    # Cumulative sums start anew with each node: what all nodes before it hold is taken off.
    before_n, before_s = np.cumsum(n) - n, np.cumsum(s) - s
    left_n, left_s = left_n - before_n[nodes], left_s - before_s[nodes]
    right_n, right_s = n[nodes] - left_n, s[nodes] - left_s
    able = np.zeros((features, samples), bool)
    able[:, :-1] = (nodes[:, 1:] == nodes[:, :-1]) & (ranks[:, 1:] != ranks[:, :-1])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(able, left_s**2 / left_n + right_s**2 / right_n, -np.inf)
    starts = np.flatnonzero(np.r_[True, nodes[0, 1:] != nodes[0, :-1]])  # the same for all features
    present, lengths = nodes[0, starts], np.diff(np.r_[starts, samples])
    highest = np.maximum.reduceat(gain, starts, axis=1)
    top = highest.max(axis=0)
    feature = (highest >= top * (1 - 1e-12)).argmax(axis=0)  # gains are never negative
    column = np.arange(samples)
    here = gain[np.repeat(feature, lengths), column] == np.repeat(highest[feature, np.arange(len(starts))], lengths)
    at = np.flatnonzero(here)
    at = at[np.searchsorted(at, starts)]  # each node's first
    best, where, above = np.full(size, -1), np.zeros(size, int), np.zeros(size, int)
    cuttable = top > -np.inf
    best[present[cuttable]] = feature[cuttable]
    where[present], above[present] = ranks[feature, at], ranks[feature, np.minimum(at + 1, samples - 1)]
    return best, where, above


def forest(x: np.ndarray, y: np.ndarray, new: np.ndarray, trees: int = 100, depth: int = 15, bootstrap: bool = True) -> np.ndarray:
    """Mean of trees, each on as many rows as there are, drawn with replacement; all features at every cut."""
    draws = np.random.default_rng(SEED)
    if bootstrap:
        weight = np.stack([np.bincount(draws.integers(0, len(y), len(y)), minlength=len(y)) for _ in range(trees)])
    else:
        weight = np.ones((trees, len(y)), int)
    return grow(x, y, weight, depth)[0].predict(new).mean(axis=1)


def boosting(x: np.ndarray, y: np.ndarray, new: np.ndarray, trees: int = 100, depth: int = 10, rate: float = 0.1) -> np.ndarray:
    """The mean, then trees one after the other on what is left, each taken at a tenth."""
    level = y.mean()
    fitted, out, once = np.full(len(y), level), np.full(len(new), level), np.ones((1, len(y)), int)
    for _ in range(trees):
        grown, leaf = grow(x, y - fitted, once, depth)
        fitted = fitted + rate * grown.mean[leaf[0]]
        out = out + rate * grown.predict(new)[:, 0]
    return out
