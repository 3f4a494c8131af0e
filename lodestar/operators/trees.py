"""Classification trees grown over many folds at once, and pruned by cost and complexity.

A scan routes every row through the trees grown so far and counts (feature, bin, class) for every open node of every
tree; counts are merged by a tree of tasks and the best split of a node is chosen where they meet, so only
splits come to the driver.  One tree is grown on all rows and one without each fold, level by level, all in the
same scans.  Weakest links are then cut off one after the other; the folds' trees, pruned at the
geometric means of the cut values, give the error of each size, and the one-standard-error rule its choice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.partials import array_sums, matrix, merged

#: Counts that one scan may gather in a task; more open nodes take several scans.
MOST_COUNTS = 1 << 22


def equal_width_edges(df: DataFrame, vec: str, bins: int) -> np.ndarray:
    """(features × bins − 1) candidate thresholds that cut the range of every feature into equal parts."""
    p = df.select(F.size(vec).alias("p")).first()["p"]
    ends = df.agg(*[F.min(F.col(vec)[i]).alias(f"l{i}") for i in range(p)], *[F.max(F.col(vec)[i]).alias(f"h{i}") for i in range(p)]).first()
    lo, hi = np.array(ends[:p], dtype=float), np.array(ends[p:], dtype=float)
    return lo[:, None] + (hi - lo)[:, None] * np.arange(1, bins) / bins


def quantile_edges(df: DataFrame, vec: str, bins: int, error: float = 0.001) -> np.ndarray:
    """Candidate thresholds at approximate quantiles of every feature, repeated where values repeat."""
    p = df.select(F.size(vec).alias("p")).first()["p"]
    wide = df.select(*[F.col(vec)[i].alias(f"x{i}") for i in range(p)])
    return np.array(wide.approxQuantile([f"x{i}" for i in range(p)], [i / bins for i in range(1, bins)], error))


@dataclass
class Tree:
    """Nodes as parallel lists; a row goes left where its feature is at most the threshold."""

    counts: list[np.ndarray]
    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [math.nan])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, threshold: float, left: np.ndarray, right: np.ndarray) -> None:
        for counts in (left, right):
            self.counts.append(counts)
            self.feature.append(-1)
            self.threshold.append(math.nan)
            self.left.append(-1)
            self.right.append(-1)
            self.depth.append(self.depth[node] + 1)
        self.feature[node], self.threshold[node] = feature, threshold
        self.left[node], self.right[node] = len(self.counts) - 2, len(self.counts) - 1

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right)

    def route(self, x: np.ndarray, stop: np.ndarray | None = None) -> np.ndarray:
        """The node in which each row ends; nodes marked in ``stop`` are not left."""
        feature, threshold, left, right = self.arrays()
        node, rows = np.zeros(len(x), dtype=int), np.arange(len(x))
        for _ in range(max(self.depth)):
            f = feature[node]
            go = f >= 0 if stop is None else (f >= 0) & ~stop[node]
            low = x[rows, np.maximum(f, 0)] <= threshold[node]
            node = np.where(go, np.where(low, left[node], right[node]), node)
        return node

    def labels(self) -> np.ndarray:
        """The commonest class of every node, the smallest among equals."""
        return np.array([int(np.argmax(c)) for c in self.counts])

    def wrong(self) -> np.ndarray:
        return np.array([c.sum() - c.max() for c in self.counts])


def _best(counts: np.ndarray, least: int) -> tuple[float, int, int] | None:
    """(score, feature, bin) of the best split of (features × bins × classes) counts; ties go to the first feature, then bin.

    The score is Σ_c L_c² / L + Σ_c R_c² / R, which falls and rises with the Gini impurity of the two sides.
    """
    low = np.cumsum(counts, axis=1)[:, :-1]
    high = counts.sum(axis=1, keepdims=True) - low
    n_low, n_high = low.sum(axis=2), high.sum(axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (low ** 2).sum(axis=2) / n_low + (high ** 2).sum(axis=2) / n_high
    score = np.where((n_low >= least) & (n_high >= least), score, -np.inf)
    if not score.size or not np.isfinite(score.max()):
        return None
    f, b = np.unravel_index(int(np.argmax(score)), score.shape)
    return float(score[f, b]), int(f), int(b)


def _parts(batches):
    """(vectors, labels, folds) of a few thousand rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            part = batch.slice(at, 8192)
            yield matrix(part.column(0)), part.column(1).to_numpy(zero_copy_only=False), part.column(2).to_numpy(zero_copy_only=False)


class Forest:
    """Trees over one table: number 0 on all rows, number f without fold f."""

    def __init__(self, df: DataFrame, edges: np.ndarray, classes: int, folds: int = 0, vec: str = "v", label: str = "label", fold: str | None = None,
                 max_depth: int = 30, min_rows: int = 1):
        own = F.col(fold).cast("int") if fold else F.lit(0)
        self.rows = df.select(F.col(vec).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"), own.alias("fold")).cache()
        self.edges, self.classes, self.folds, self.max_depth, self.min_rows = edges, classes, folds, max_depth, min_rows
        self.trees: list[Tree] = []

    def grow(self) -> list[Tree]:
        """All trees, level by level."""
        k, folds = self.classes, self.folds

        def roots(batches):
            total = np.zeros((folds + 1, k))
            for _, y, fold in _parts(batches):
                for t in range(folds + 1):
                    total[t] += np.bincount(y[(fold != t) | (t == 0)], minlength=k)
            return {"n": total}

        found = array_sums(self.rows, roots).get("n", np.zeros((folds + 1) * k)).reshape(folds + 1, k)
        self.trees = [Tree([n]) for n in found]
        open_nodes = [(t, 0) for t in range(folds + 1)]
        per_node = self.edges.shape[0] * (self.edges.shape[1] + 1) * k
        for _ in range(self.max_depth):
            open_nodes = [(t, n) for t, n in open_nodes if self.trees[t].wrong()[n] > 0 and self.trees[t].counts[n].sum() >= 2 * self.min_rows]
            if not open_nodes:
                break
            size = max(1, MOST_COUNTS // per_node)
            made = []
            for at in range(0, len(open_nodes), size):
                made += self._level(open_nodes[at:at + size])
            open_nodes = made
        return self.trees

    def _level(self, nodes: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Split ``nodes`` where a split makes them purer; the children."""
        edges, k, trees, least = self.edges, self.classes, self.trees, self.min_rows
        p, b = edges.shape[0], edges.shape[1] + 1
        wanted = {t: np.array([n for u, n in nodes if u == t]) for t in {t for t, _ in nodes}}

        def reduce(batches):
            total: dict[str, np.ndarray] = {}
            for x, y, fold in _parts(batches):
                bins = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(p)], axis=1)
                cell = (np.arange(p) * b + bins) * k + y[:, None]
                for t, own in wanted.items():
                    node = trees[t].route(x)
                    node[(fold == t) & (t > 0)] = -1
                    for n in own:
                        here = cell[node == n]
                        if len(here):
                            name = f"{t}:{n}"
                            total[name] = total.get(name, 0) + np.bincount(here.ravel(), minlength=p * b * k)
            return total

        def choose(batches):
            for batch in batches:
                for name, total in zip(batch.column(0).to_pylist(), batch.column(3)):
                    counts = total.values.to_numpy(zero_copy_only=False).reshape(p, b, k)
                    best = _best(counts, least)
                    if best is not None:
                        score, f, at = best
                        low = counts[f, :at + 1].sum(axis=0)
                        yield pa.RecordBatch.from_pylist([{"name": name, "score": score, "feature": f, "bin": at, "low": low.tolist(),
                                                           "high": (counts[f].sum(axis=0) - low).tolist()}])

        splits = merged(self.rows, reduce, whole=True).mapInArrow(choose, "name string, score double, feature long, bin long, low array<double>, high array<double>")
        out = []
        for r in sorted(splits.collect(), key=lambda r: tuple(map(int, r["name"].split(":")))):  # one row for each node
            t, n = map(int, r["name"].split(":"))
            whole = self.trees[t].counts[n]
            if r["score"] > (whole ** 2).sum() / whole.sum() * (1 + 1e-12):
                self.trees[t].split(n, r["feature"], float(edges[r["feature"], r["bin"]]), np.array(r["low"]), np.array(r["high"]))
                out += [(t, self.trees[t].left[n]), (t, self.trees[t].right[n])]
        return out

    def held_out(self, stops: Sequence[Sequence[np.ndarray]]) -> np.ndarray:
        """(folds × sizes × 2) wrong and all rows of every fold, by its own tree cut at each of its ``stops`` masks."""
        trees, folds, sizes = self.trees, self.folds, len(stops[0]) if stops else 0
        labels = [t.labels() for t in trees]

        def reduce(batches):
            total = np.zeros((folds, sizes, 2))
            for x, y, fold in _parts(batches):
                for f in range(1, folds + 1):
                    own = fold == f
                    if own.any():
                        for s, stop in enumerate(stops[f - 1]):
                            end = trees[f].route(x[own], stop)
                            total[f - 1, s] += [(labels[f][end] != y[own]).sum(), own.sum()]
            return {"w": total}

        return array_sums(self.rows, reduce).get("w", np.zeros(folds * sizes * 2)).reshape(folds, sizes, 2)

    def close(self) -> None:
        self.rows.unpersist()


def weakest_links(tree: Tree) -> tuple[np.ndarray, list[tuple[float, int, float]]]:
    """(value at which each node is cut, the sequence of (alpha, leaves, share of wrong rows)).

    A node's link is the rise of the share of wrong rows for each leaf saved by cutting below it.  The weakest are cut
    first; alpha rises from one tree of the sequence to the next, down to the root.  The cut value of a leaf is −∞.
    """
    n, wrong = max(tree.counts[0].sum(), 1.0), tree.wrong()
    cut = np.full(len(wrong), -math.inf)
    inner = [i for i in range(len(wrong)) if tree.feature[i] >= 0]
    cut[inner] = math.inf
    sequence, alpha = [], 0.0
    while True:
        leaves, risk = np.ones(len(wrong)), wrong.astype(float).copy()
        reach = np.zeros(len(wrong), dtype=bool)
        reach[0] = True
        for i in range(len(wrong)):  # parents come before their children
            if reach[i] and cut[i] == math.inf:
                reach[tree.left[i]] = reach[tree.right[i]] = True
        for i in reversed(range(len(wrong))):
            if cut[i] == math.inf:
                leaves[i] = leaves[tree.left[i]] + leaves[tree.right[i]]
                risk[i] = risk[tree.left[i]] + risk[tree.right[i]]
        live = [i for i in inner if reach[i] and cut[i] == math.inf]
        links = {i: (wrong[i] - risk[i]) / n / (leaves[i] - 1) for i in live}
        free = [i for i in live if links[i] <= alpha + 1e-15]
        if free:  # nothing is lost by these
            for i in free:
                cut[i] = alpha
            continue
        sequence.append((alpha, int(leaves[0]), float(risk[0] / n)))
        if not live:
            return cut, sequence
        alpha = float(min(links.values()))


def prune(forest: Forest) -> list[dict]:
    """The sequence of pruned trees with the held-out error of each size: rows (alpha, leaves, train_error, wrong, rows, cv_error, se, is_best,
    one_se_choice); the choice is the smallest tree within one standard error of the best."""
    _, sequence = weakest_links(forest.trees[0])
    alphas = [a for a, _, _ in sequence]
    at = [math.sqrt(a * b) for a, b in zip(alphas, alphas[1:])] + [math.inf]
    cuts = [weakest_links(t)[0] for t in forest.trees[1:]]
    found = forest.held_out([[c <= a for a in at] for c in cuts]) if cuts else np.zeros((0, len(at), 2))
    out = []
    for s, (alpha, leaves, train) in enumerate(sequence):
        wrong, rows = found[:, s, 0], found[:, s, 1]
        shares = wrong / np.maximum(rows, 1)
        se = float(np.std(shares, ddof=1) / math.sqrt(len(shares))) if len(shares) > 1 else 0.0
        out.append({"alpha": alpha, "leaves": leaves, "train_error": train, "wrong": int(wrong.sum()), "rows": int(rows.sum()),
                    "cv_error": float(wrong.sum() / max(rows.sum(), 1)), "se": se})
    best = min(range(len(out)), key=lambda i: (out[i]["cv_error"], out[i]["leaves"]))
    choice = max(i for i in range(len(out)) if out[i]["cv_error"] <= out[best]["cv_error"] + out[best]["se"])
    return [r | {"is_best": i == best, "one_se_choice": i == choice} for i, r in enumerate(out)]
