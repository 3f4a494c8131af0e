"""Kernel methods on landmark features, and kernel change points.

A kernel matrix over n rows is never formed.  A bounded set of landmark rows gives every row a short
feature vector φ(x) = K(x, L) · K(L, L)^(−1/2) whose dot products are the kernel's best approximation
over the landmarks, and its exact values once the landmarks span all rows.  Everything after that is
Gram algebra on the features.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators import blocks
from lodestar.operators.moments import gram_entries
from lodestar.operators.prefix import global_row_number, running_totals
from lodestar.operators.sampling import hash_order

#: Landmarks unless the caller names another number.
LANDMARKS = 256


def gaussian(a: np.ndarray, b: np.ndarray, sigma: float) -> np.ndarray:
    """exp(−‖a − b‖² / σ²) for every pair of rows."""
    return np.exp(-blocks.exact_sq_dists(a, b) / (sigma * sigma))


class Landmarks:
    """Landmark rows and the matrix that turns kernel values against them into features."""

    def __init__(self, rows: np.ndarray, sigma: float):
        self.rows, self.sigma = rows, sigma
        w, v = np.linalg.eigh(gaussian(rows, rows, sigma))
        keep = w > 1e-10 * max(w.max(initial=0.0), 1e-300)
        self.turn = v[:, keep] / np.sqrt(w[keep])

    def features(self, x: np.ndarray) -> np.ndarray:
        return gaussian(x, self.rows, self.sigma) @ self.turn


def choose_landmarks(df: DataFrame, key: str, vec: str, sigma: float, n: int = LANDMARKS, seed: int = 0) -> Landmarks:
    """The first ``n`` rows in seeded hash order: a bounded number of vectors comes to the driver."""
    rows = df.select(key, vec).orderBy(hash_order(key, seed), key).limit(n).collect()
    return Landmarks(np.array([r[vec] for r in rows], dtype=float), sigma)


def featurize(df: DataFrame, marks: Landmarks, vec: str = "v", out: str = "phi") -> DataFrame:
    """Adds the landmark features of every row."""
    schema = df.withColumn(out, F.lit(None).cast("array<double>")).schema

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: list(marks.features(blocks.matrix(pdf[vec])))})

    return df.mapInPandas(run, schema)


def feature_gram(df: DataFrame, phi: str = "phi", centre: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, Σ φφᵀ about the mean or the origin, n): the spectrum of K on the features' side."""
    from lodestar.operators.moments import mean_sd_arrays

    first = mean_sd_arrays(df, phi).first()
    mean = np.asarray(first["mean"]) if centre else np.zeros(len(first["mean"]))
    m, n = np.zeros((len(mean), len(mean))), 0
    for r in gram_entries(df, vec=phi, center=list(mean)).collect():  # landmarks squared
        m[r["i"], r["j"]], n = r["s"], r["n"]
    return mean, m, n


def kernel_pca(df: DataFrame, marks: Landmarks, k: int, vec: str = "v", out: str = "kpcs") -> tuple[np.ndarray, DataFrame]:
    """M9: (all eigenvalues of the centred kernel matrix, df with the scores on the first ``k``).

    Scores are projections of the centred features; each component's largest loading is positive.
    """
    phi = featurize(df, marks, vec)
    mean, m, _ = feature_gram(phi)
    w, v = np.linalg.eigh(m)
    order = np.argsort(w)[::-1]
    w, v = w[order], v[:, order[:k]]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    schema = df.withColumn(out, F.lit(None).cast("array<double>")).schema

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: list((marks.features(blocks.matrix(pdf[vec])) - mean) @ v)})

    return w, df.mapInPandas(run, schema)


def effective_dof(eigenvalues: np.ndarray, lam: float) -> float:
    """Trace of K (K + λI)⁻¹ = Σ d / (d + λ)."""
    d = np.maximum(np.asarray(eigenvalues), 0.0)
    return float(np.sum(d / (d + lam)))


def kernel_logistic(df: DataFrame, marks: Landmarks, lam: float, iters: int = 60, vec: str = "v", label: str = "y",
                    rate: float = 1.0) -> tuple[list[dict], DataFrame]:
    """Logistic regression in the kernel's feature space (0/1 labels), by accelerated gradients.

    The penalty λ/2 · αᵀKα is λ/2 times the squared feature weights.  Returns the history and the
    features, so that a score is sigmoid(φ · w).
    """
    from lodestar.operators import nets

    phi = featurize(df, marks, vec)
    p = marks.turn.shape[1]
    return nets.train(phi, p, nets.logistic_grad, lam=lam, iters=iters, vec="phi", label=label, free=np.zeros(p, dtype=bool),
                      step=nets.Nesterov(rate)), phi


def change_point(series: DataFrame, order: str, value: str, sigma: float) -> DataFrame:
    """(t, order, score) for every split after t rows; the largest score is the change point.

    score = (n−t)/(n·t) · Σ K before + t/(n·(n−t)) · Σ K after − 2/n · Σ K across.  Each row needs the sum of its
    kernel values with all rows and with earlier rows; both come from block pairs that are reduced as
    they are made, and running totals over rows give all three sums for every split.
    """
    s = global_row_number(series.select(F.col(order).alias("at"), F.col(value).cast("double").alias("y")), [("at", True), ("y", True)], "pos")

    def one(k: np.ndarray, rows: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        earlier = others["pos"].to_numpy()[None, :] < rows["pos"].to_numpy()[:, None]
        return pd.DataFrame({"pos": rows["pos"], "at": rows["at"], "row": k.sum(axis=1), "before": (k * earlier).sum(axis=1)})

    def sums(left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
        k = gaussian(left[["y"]].to_numpy(), right[["y"]].to_numpy(), sigma)
        made = one(k, left, right)
        return made if same else pd.concat([made, one(k.T, right, left)])

    kind = s.schema["at"].dataType.simpleString()
    parts = blocks.symmetric_blocks(s, "pos", sums, f"pos long, at {kind}, row double, before double", blocks.pair_blocks(s))
    rows = parts.groupBy("pos", "at").agg(F.sum("row").alias("row"), F.sum("before").alias("before"))
    run = running_totals(rows, [("pos", True)], {"inside": 2 * F.col("before") + 1.0, "rows": F.col("row")})
    n, total = rows.agg(F.count(F.lit(1)), F.sum("row")).first()  # two numbers
    t, n = F.col("pos").cast("double"), float(n)
    across = F.col("rows") - F.col("inside")
    after = F.lit(total) - F.col("inside") - 2 * across
    score = (n - t) / (n * t) * F.col("inside") + t / (n * (n - t)) * after - 2 / n * across
    return run.where(F.col("pos") < n).select(F.col("pos").alias("t"), "at", score.alias("score"))


def layer_probe(df: DataFrame, net, w: np.ndarray, sigmas: list[float], d: int, n_classes: int, key: str = "vec_id",
                label: str = "label", vec: str = "v", landmarks: int = 64) -> list[dict]:
    """For the input and each hidden layer: kernel PCA to ``d`` scores, a linear classifier on them, and the
    smallest training error over the kernel widths."""
    from lodestar.operators import layers, nets

    out = []
    for layer in range(len(net.sizes) - 1):
        values = layers.layer_values(df.select(key, label, vec), net, w, layer, vec)
        rows = values.count()
        best = None
        for sigma in sigmas:
            marks = choose_landmarks(values, key, "values", sigma, landmarks)
            _, scored = kernel_pca(values, marks, d, "values")
            k = min(d, marks.turn.shape[1])
            probe = layers.Layers([k, n_classes], loss="cross_entropy")
            fitted = nets.train(scored, probe.n_weights, probe.gradient, step=nets.Nesterov(1.0), iters=8, vec="kpcs", label=label,
                                start=np.zeros(probe.n_weights), free=probe.biases())[-1]["weights"]
            error = layers.error_rate(layers.mlp_score(scored, probe, np.array(fitted), "kpcs"), label)
            if best is None or error < best["error"]:
                best = {"layer": layer, "rows": rows, "sigma": sigma, "error": error}
        out.append(best)
    return out
