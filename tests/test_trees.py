"""Trees of single series against brute force."""

import numpy as np
import pytest

from isochron.operators import trees


def slow_tree(x, y, w, depth):
    """A tree as nested tuples, by trying every cut."""
    mean = np.average(y, weights=w)
    if depth == 0 or np.average((y - mean) ** 2, weights=w) <= 1e-9 * max(1.0, mean**2):
        return mean
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for low, high in zip(values, values[1:], strict=False):
            left = x[:, f] <= low
            gain = (w * y)[left].sum() ** 2 / w[left].sum() + (w * y)[~left].sum() ** 2 / w[~left].sum()
            if best is None or gain > best[0] * (1 + 1e-12):
                best = gain, f, (low + high) / 2, left
    if best is None:
        return mean
    _, f, cut, left = best
    return f, cut, slow_tree(x[left], y[left], w[left], depth - 1), slow_tree(x[~left], y[~left], w[~left], depth - 1)


def slow_predict(tree, row):
    while isinstance(tree, tuple):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def cases(seed, n=60, features=4):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=(n, features - 1)), rng.integers(0, 3, n)]
    return x, 50 + 10 * x[:, 0] * (x[:, 1] > 0) + rng.normal(size=n), np.c_[rng.normal(size=(20, features - 1)), rng.integers(0, 3, 20)]


@pytest.mark.parametrize("depth", [0, 1, 2, 5, 15])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trees_equal_brute_force(seed, depth):
    x, y, new = cases(seed)
    rng = np.random.default_rng(seed)
    weight = np.stack([np.bincount(rng.integers(0, len(y), len(y)), minlength=len(y)) for _ in range(4)])
    grown, leaf = trees.grow(x, y, weight, depth)
    found = grown.predict(new)
    for t, w in enumerate(weight):
        drawn = w > 0
        slow = slow_tree(x[drawn], y[drawn], w[drawn].astype(float), depth)
        assert found[:, t] == pytest.approx([slow_predict(slow, row) for row in new])
        assert grown.mean[leaf[t][drawn]] == pytest.approx([slow_predict(slow, row) for row in x[drawn]])
        assert (leaf[t][~drawn] == -1).all()


def test_boosting_equals_its_rounds():
    x, y, new = cases(7)
    level, out = np.full(len(y), y.mean()), np.full(len(new), y.mean())
    for _ in range(6):
        slow = slow_tree(x, y - level, np.ones(len(y)), 3)
        level = level + 0.1 * np.array([slow_predict(slow, row) for row in x])
        out = out + 0.1 * np.array([slow_predict(slow, row) for row in new])
    assert trees.boosting(x, y, new, trees=6, depth=3) == pytest.approx(out)


def test_forests_draw_alike_every_time_and_learn():
    x, y, new = cases(11, 240)
    first = trees.forest(x, y, new)
    assert (first == trees.forest(x, y, new)).all()
    truth = 50 + 10 * new[:, 0] * (new[:, 1] > 0)
    assert np.abs(first - truth).mean() < 0.25 * np.abs(truth - y.mean()).mean()
    assert np.abs(trees.boosting(x, y, new) - truth).mean() < 0.35 * np.abs(truth - y.mean()).mean()


@pytest.mark.parametrize("model", [trees.forest, trees.boosting])
def test_nothing_to_cut(model):
    x, y = np.ones((5, 2)), np.arange(5.0)
    assert model(x, y, x[:1], trees=1, depth=3, **({"bootstrap": False} if model is trees.forest else {})) == pytest.approx([2.0])
    assert model(np.empty((3, 0)), np.full(3, 4.0), np.empty((2, 0)), trees=2, depth=2) == pytest.approx([4.0, 4.0])
    assert model(np.array([[1.0]]), np.array([9.0]), np.array([[5.0]]), trees=2, depth=2) == pytest.approx([9.0])
