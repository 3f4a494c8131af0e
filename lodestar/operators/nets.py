"""Distributed gradient sums and gradient-trained models.

Each iteration broadcasts the current weights inside the plan, every
partition reduces its rows to one partial (gradient sum, loss sum, row count)
with NumPy on Arrow batches, and a tree of fixed fan-in merges them chunk by chunk.
The update rule runs on the driver over p numbers (pluggable, X6).  The
training table is cached once; it never returns to the driver.  Where the loss
is a quadratic form of the weights, one scan takes the moments of all rows, and
every iteration's gradient and loss follow from them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.layers import Layers, rows_of
from lodestar.operators.partials import array_sums, matrix
from lodestar.session import cut_lineage


def gradient_sum(df: DataFrame, w: np.ndarray, grad_fn: Callable, vec: str = "x", label: str = "y") -> tuple[np.ndarray, float, int]:
    """Σ per-row gradients and losses at ``w`` (D13): one partial for each task, merged as chunks of weights by a tree."""
    wl = w.copy()
    p = wl.shape[0]

    def reduce(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        g, loss, n = np.zeros(p), 0.0, 0
        for batch in batches:
            if batch.num_rows:
                x, y = rows_of(batch.to_pandas(), vec, label)
                gg, ll = grad_fn(x, y, wl)
                g += gg
                loss += ll
                n += batch.num_rows
        return {"g": g, "more": np.array([loss, float(n)])} if n else {}

    got = array_sums(df.select(vec, label), reduce)
    loss, n = got.get("more", np.zeros(2))
    return got.get("g", np.zeros(p)), float(loss), int(n)


def moments(df: DataFrame, net: Layers, vec: str = "x", label: str = "y") -> np.ndarray:
    """Σ zzᵀ over all rows z = (1, inputs, targets): what a quadratic loss needs of them, in one scan."""
    side = 1 + net.sizes[0] + net.sizes[-1]

    def reduce(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        total, n = np.zeros((side, side)), 0
        for batch in batches:
            if batch.num_rows:
                y = batch.column(label)
                total += net.moments(matrix(batch.column(vec)), matrix(y) if pa.types.is_list(y.type) else y.to_numpy(zero_copy_only=False).astype(np.float64))
                n += batch.num_rows
        return {"m": total} if n else {}

    return array_sums(df.select(vec, label), reduce).get("m", np.zeros(side * side)).reshape(side, side)


def logistic_grad(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient and loss sums of the logistic loss (factor 1, D11); y in 0/1."""
    z = x @ w
    p = 1.0 / (1.0 + np.exp(-z))
    loss = np.sum(np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z))) - y * z)
    return x.T @ (p - y), float(loss)


def squared_grad(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float]:
    r = x @ w - y
    return x.T @ r, float(0.5 * np.sum(r * r))


class Sgd:
    """Plain gradient steps."""

    def __init__(self, rate: float, decay: float = 0.0):
        self.rate, self.decay = rate, decay

    def at(self, t: int) -> float:
        return self.rate * t ** -self.decay

    def __call__(self, w: np.ndarray, g: np.ndarray, t: int) -> np.ndarray:
        return w - self.at(t) * g


class Nesterov(Sgd):
    """Nesterov steps with momentum t / (t + 3)."""

    def __init__(self, rate: float, decay: float = 0.0):
        super().__init__(rate, decay)
        self.last: np.ndarray | None = None

    def __call__(self, w: np.ndarray, g: np.ndarray, t: int) -> np.ndarray:
        moved = w - self.at(t) * g
        last = w if self.last is None else self.last
        self.last = moved
        return moved + (t / (t + 3.0)) * (moved - last)


class Adagrad(Sgd):
    """Steps divided by the root of each weight's summed squared gradients."""

    def __init__(self, rate: float, decay: float = 0.0):
        super().__init__(rate, decay)
        self.square = 0.0

    def __call__(self, w: np.ndarray, g: np.ndarray, t: int) -> np.ndarray:
        self.square = self.square + g * g
        return w - self.at(t) * g / np.sqrt(self.square + 1e-12)


STEPS = {"sgd": Sgd, "nesterov": Nesterov, "adagrad": Adagrad}


def train(df: DataFrame, p: int, grad_fn: Callable = logistic_grad, rate: float = 0.5, lam: float = 0.0,
          iters: int = 60, tol: float = 1e-6, vec: str = "x", label: str = "y", step: Sgd | None = None,
          start: np.ndarray | None = None, free: np.ndarray | None = None, batches: int = 1, key: str | None = None,
          anchor: float = 0.0, sums: np.ndarray | None = None) -> list[dict]:
    """Distributed gradient training; the history, whose last row holds the weights.

    ``step`` is any step rule (default: Nesterov at ``rate``).  With ``batches`` > 1 rows are dealt
    into that many batches by a hash of ``key`` and each iteration reads one of them.  ``lam`` is an L2
    penalty on all weights but those marked ``free`` (default: the first, the intercept); ``anchor`` is
    a proximal term that holds the weights near ``start``.  Training stops when the norm of the
    gradient is under ``tol`` or after ``iters`` iterations.

    Over all rows at once (``batches`` = 1) the gradient of a quadratic ``Layers`` comes from its ``moments``: one scan whatever
    ``iters`` is, or none where several trainings share ``sums``.
    """
    from lodestar.operators.sampling import hash_order

    cols = [vec, label]
    net = getattr(grad_fn, "__self__", None)
    if batches == 1 and isinstance(net, Layers) and net.quadratic and grad_fn == net.gradient:
        sums = moments(df, net, vec, label) if sums is None else sums
        data = None
    else:
        data = df.select(*cols, *([F.pmod(hash_order(key), F.lit(batches)).alias("_batch")] if batches > 1 else [])).cache()
    w = np.zeros(p) if start is None else np.array(start, dtype=float)
    home = w.copy()
    held = np.arange(p) > 0 if free is None else ~np.asarray(free)
    step = step or Nesterov(rate)
    hist = []
    for t in range(1, iters + 1):
        if data is None:
            (g, loss), n = net.gradient_of(sums, w), int(sums[0, 0])
        else:
            part = data.where(F.col("_batch") == (t - 1) % batches) if batches > 1 else data
            g, loss, n = gradient_sum(part, w, grad_fn, vec, label)
        if not n:
            continue
        pen = lam * w * held
        grad = g / n + pen + anchor * (w - home)
        obj = loss / n + 0.5 * lam * float(np.sum((w * held) ** 2)) + 0.5 * anchor * float(np.sum((w - home) ** 2))
        hist.append({"iteration": t, "loss": obj, "grad_norm": float(np.linalg.norm(grad))})
        if batches == 1 and np.linalg.norm(grad) < tol:
            break
        w = step(w, grad, t)
    if data is not None:
        data.unpersist()
    if hist:
        hist[-1]["weights"] = w.tolist()
    return hist


def lipschitz_step(df: DataFrame, p: int, grad_fn: Callable = logistic_grad, seed: int = 0,
                   vec: str = "x", label: str = "y") -> float:
    """1/L with L = ‖∇f(a) − ∇f(b)‖ / ‖a − b‖ at two random points (plain norms, D12)."""
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=p), rng.normal(size=p)
    ga, _, n = gradient_sum(df, a, grad_fn, vec, label)
    gb, _, _ = gradient_sum(df, b, grad_fn, vec, label)
    lip = np.linalg.norm((ga - gb) / n) / np.linalg.norm(a - b)
    return float(1.0 / lip) if lip > 0 else float("inf")


def hard_negative_training(df: DataFrame, key: str, vec: str, label: str, p: int, rounds: int = 10, iters: int = 60,
                           rate: float = 0.5, lam: float = 1e-3, anchor: float = 0.0, seed: int = 0) -> list[dict]:
    """Fit on positives and random negatives, then ``rounds`` times: score all, mine (T6), fit again from the last weights.

    ``anchor`` holds each fit near the weights it starts from.  A row of the history has the round, the
    numbers of positives and negatives it was fitted on, its last loss and its weights.
    """
    from lodestar.operators.sampling import hard_negatives

    out, w = [], np.zeros(p)
    for r in range(rounds + 1):
        scored = df.withColumn("_score", sum((F.lit(float(c)) * F.col(vec)[i] for i, c in enumerate(w)), F.lit(0.0)))
        mined = hard_negatives(scored, key, "_score", label, seed=seed + r, first_round=r == 0)
        part = cut_lineage(mined.select(vec, label))
        n = dict(part.groupBy(label).count().collect())  # two numbers
        hist = train(part, p, rate=rate, lam=lam, iters=iters, vec=vec, label=label, start=w, anchor=anchor if r else 0.0)
        w = np.array(hist[-1]["weights"]) if hist else w
        out.append({"round": r, "positives": n.get(1, 0), "negatives": n.get(0, 0), "loss": hist[-1]["loss"] if hist else float("nan"),
                    "weights": w.tolist()})
    return out
