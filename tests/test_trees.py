"""Trees against plain searches: growth, weakest links, held-out errors."""

import itertools
import math

import numpy as np
import pytest

from lodestar.operators import trees


def make(spark, x, y, fold=None):
    rows = [(x[i].tolist(), int(y[i]), int(fold[i]) if fold is not None else 0) for i in range(len(y))]
    return spark.createDataFrame(rows, "v array<double>, label int, fold int").repartition(4)


def plain_split(x, y, edges, classes):
    """Best (score, feature, edge) by trying every threshold."""
    best = None
    for f, own in enumerate(edges):
        for b, t in enumerate(own):
            low = x[:, f] <= t
            if low.any() and (~low).any():
                score = sum((np.bincount(y[s], minlength=classes).astype(float) ** 2).sum() / s.sum() for s in (low, ~low))
                if best is None or score > best[0]:
                    best = (score, f, b)
    return best


def plain_tree(x, y, edges, classes, depth):
    """{path: (feature, edge)} of the tree grown by repeated search."""
    out = {}

    def grow(path, rows):
        own = y[rows]
        if len(path) == depth or len(set(own)) < 2:
            return
        best = plain_split(x[rows], own, edges, classes)
        if best and best[0] > (np.bincount(own) ** 2).sum() / len(own) * (1 + 1e-12):
            out[path] = best[1:]
            low = x[rows, best[1]] <= edges[best[1]][best[2]]
            grow(path + "l", rows[low])
            grow(path + "r", rows[~low])

    grow("", np.arange(len(y)))
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, (260, 4)).astype(float)
    y = ((x[:, 0] > 5).astype(int) + 2 * (x[:, 2] > 8)) % 3
    y = np.where(rng.random(260) < 0.15, rng.integers(0, 3, 260), y)
    return x, y, np.arange(260) % 3 + 1


def test_growth_equals_a_plain_search(spark, data):
    x, y, fold = data
    edges = np.tile(np.arange(0.5, 11.0), (4, 1))
    old, trees.MOST_COUNTS = trees.MOST_COUNTS, 400  # a few nodes in each scan
    try:
        forest = trees.Forest(make(spark, x, y, fold), edges, 3, 3, fold="fold", max_depth=4)
        grown = forest.grow()
    finally:
        trees.MOST_COUNTS = old
    for number, tree in enumerate(grown):
        own = (fold != number) | (number == 0)
        want = plain_tree(x[own], y[own], edges, 3, 4)
        got, paths = {}, {0: ""}
        for i in range(len(tree.counts)):
            if tree.feature[i] >= 0:
                got[paths[i]] = (tree.feature[i], int(np.flatnonzero(edges[tree.feature[i]] == tree.threshold[i])[0]))
                paths[tree.left[i]], paths[tree.right[i]] = paths[i] + "l", paths[i] + "r"
        assert got == want
        assert all(tree.counts[i].sum() == (tree.route(x[own], np.arange(len(tree.counts)) == i) == i).sum() for i in range(len(tree.counts)) if tree.depth[i] < 2)
    rows = trees.prune(forest)
    alphas = [r["alpha"] for r in rows]
    assert alphas == sorted(alphas) and [r["leaves"] for r in rows] == sorted((r["leaves"] for r in rows), reverse=True) and rows[-1]["leaves"] == 1
    assert [r["train_error"] for r in rows] == sorted(r["train_error"] for r in rows)
    best = next(r for r in rows if r["is_best"])
    assert best["cv_error"] < rows[-1]["cv_error"] - 0.1 and all(r["rows"] == 260 for r in rows)
    choice = next(r for r in rows if r["one_se_choice"])
    assert choice["leaves"] <= best["leaves"] and choice["cv_error"] <= best["cv_error"] + best["se"]
    # the error of the unpruned trees, by hand
    wrong = sum((grown[f].labels()[grown[f].route(x[fold == f])] != y[fold == f]).sum() for f in (1, 2, 3))
    assert forest.held_out([[t.wrong() < 0] for t in grown[1:]]).sum(axis=0)[0].tolist() == [wrong, 260]
    forest.close()


def test_weakest_links_minimise_cost_and_complexity():
    rng = np.random.default_rng(0)
    for _ in range(20):
        tree = trees.Tree([np.zeros(2)])
        for i in range(4):
            open_nodes = [n for n in range(len(tree.counts)) if tree.feature[n] < 0]
            tree.split(int(rng.choice(open_nodes)), i, 0.0, np.zeros(2), np.zeros(2))
        for n in range(len(tree.counts)):
            if tree.feature[n] < 0:
                tree.counts[n] = rng.integers(0, 9, 2).astype(float) + 1
        for n in reversed(range(len(tree.counts))):
            if tree.feature[n] >= 0:
                tree.counts[n] = tree.counts[tree.left[n]] + tree.counts[tree.right[n]]
        inner = [n for n in range(len(tree.counts)) if tree.feature[n] >= 0]

        def cost(cut, alpha):
            def walk(n):
                if tree.feature[n] < 0 or n in cut:
                    return tree.wrong()[n] / tree.counts[0].sum() + alpha, 1
                a, b = walk(tree.left[n]), walk(tree.right[n])
                return a[0] + b[0], a[1] + b[1]

            return walk(0)

        values, sequence = trees.weakest_links(tree)
        assert all(a[0] < b[0] for a, b in zip(sequence, sequence[1:])) and sequence[-1][1] == 1
        for alpha, leaves, _ in sequence:
            own = cost({n for n in inner if values[n] <= alpha}, alpha)
            assert own[1] == leaves
            every = [cost(set(c), alpha) for size in range(len(inner) + 1) for c in itertools.combinations(inner, size)]
            least = min(c[0] for c in every)
            assert abs(own[0] - least) < 1e-9 and leaves == min(n for c, n in every if c < least + 1e-9)


def test_odd_tables(spark, data):
    x, y, _ = data
    edges = np.tile(np.arange(0.5, 11.0), (4, 1))
    one = trees.Forest(make(spark, x, np.zeros(260)), edges, 1).grow()[0]
    assert len(one.counts) == 1 and one.counts[0].tolist() == [260]
    same = trees.Forest(make(spark, np.ones((50, 4)), y[:50]), edges, 3).grow()[0]
    assert len(same.counts) == 1
    empty = trees.Forest(make(spark, x[:0], y[:0]), edges, 3)
    assert [t.counts[0].tolist() for t in empty.grow()] == [[0, 0, 0]]
    assert trees.prune(empty)[0]["leaves"] == 1
    x = x.copy()
    x[::7, 0] = math.nan  # a missing value goes right
    tree = trees.Forest(make(spark, x, y), edges, 3, max_depth=3).grow()[0]
    ends = tree.route(x)
    for n in range(len(tree.counts)):
        if tree.feature[n] < 0:
            assert np.array_equal(np.bincount(y[ends == n], minlength=3), tree.counts[n])
    many = make(spark, x[:, 1:], y)
    assert trees.quantile_edges(many, "v", 8).shape == (3, 7) and trees.equal_width_edges(many, "v", 8).shape == (3, 7)
