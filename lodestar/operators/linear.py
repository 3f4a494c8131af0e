"""Gram-based linear models and model selection.

One distributed pass reduces the data to XᵀX, Xᵀy and yᵀy (``moments.gram``);
every fit, λ path, fold error and subset search afterwards is p×p algebra on
the driver — the rows are never rescanned.  Held-out fold errors come from
the fold's own Gram: Σ(y − xβ)² = yᵀy − 2βᵀXᵀy + βᵀXᵀXβ.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.moments import gram, gram_entries


def solve(xtx: np.ndarray, xty: np.ndarray, lam: float = 0.0, penalize_first: bool = False,
          omega: np.ndarray | None = None) -> np.ndarray:
    """(XᵀX + λΩ)⁺ Xᵀy; Ω defaults to I with the intercept unpenalized."""
    p = xtx.shape[0]
    if omega is None:
        omega = np.eye(p)
        if not penalize_first:
            omega[0, 0] = 0.0
    return np.linalg.pinv(xtx + lam * omega) @ xty


def predict(coefs: Sequence[float], xs: Sequence[str]) -> Column:
    """Linear predictor with literal coefficients (first is the intercept)."""
    out = F.lit(float(coefs[0]))
    for c, x in zip(coefs[1:], xs):
        out = out + F.lit(float(c)) * F.col(x)
    return out


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> np.ndarray:
    """M1: least-squares coefficients [intercept, slopes...]."""
    xtx, xty, _, _ = gram(df, y, xs)
    return solve(xtx, xty)


def centred_gram(df: DataFrame, y: str, xs: Sequence[str]) -> tuple[np.ndarray, np.ndarray, float, np.ndarray, np.ndarray, float, int]:
    """(ZᵀZ, Zᵀy, yᵀy, mean, sd, mean of y, n) of standardized columns Z and centred y.

    Means and deviations come from a first pass and are taken off before anything is multiplied, so
    no digits are lost on large sums and no column is favoured by its unit.
    """
    cols = [*xs, y]
    got = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(xs)]).first()
    mean = np.array([got[f"m{i}"] for i in range(len(xs))])
    sd = np.array([got[f"s{i}"] or 1.0 for i in range(len(xs))])
    z = df.select(*[((F.col(c) - F.lit(float(m))) / F.lit(float(d))).alias(f"z{i}") for i, (c, m, d) in enumerate(zip(xs, mean, sd))],
                  (F.col(y) - F.lit(float(got[f"m{len(xs)}"]))).alias("y"))
    ztz, zty, yty, n = gram(z, "y", [f"z{i}" for i in range(len(xs))], intercept=False)
    return ztz, zty, yty, mean, sd, float(got[f"m{len(xs)}"]), n


def ridge_path(df: DataFrame, y: str, xs: Sequence[str], lambdas: Sequence[float]) -> list[tuple[float, np.ndarray]]:
    """M2: ridge with an unpenalized intercept for each λ, on standardized columns (two passes for all λ).

    Coefficients [intercept, slopes...] are given back in the columns' own units.
    """
    ztz, zty, _, mean, sd, my, _ = centred_gram(df, y, xs)
    out = []
    for lam in lambdas:
        slope = np.linalg.pinv(ztz + lam * np.eye(len(xs))) @ zty / sd
        out.append((lam, np.r_[my - slope @ mean, slope]))
    return out


def sse_from_gram(xtx: np.ndarray, xty: np.ndarray, yty: float, beta: np.ndarray) -> float:
    return float(yty - 2 * beta @ xty + beta @ xtx @ beta)


def loo_and_gcv(df: DataFrame, y: str, xs: Sequence[str], lam: float) -> DataFrame:
    """M4: leave-one-out error via leverages h_i = xᵢᵀ(XᵀX + λΩ)⁻¹xᵢ, and GCV = mean(e²)/(1 − tr H/n)²."""
    xtx, xty, _, n = gram(df, y, xs)
    p = xtx.shape[0]
    omega = np.eye(p)
    omega[0, 0] = 0.0
    inv = np.linalg.pinv(xtx + lam * omega)
    beta = inv @ xty
    trace = float(np.trace(inv @ xtx))
    names = list(xs)

    def residuals(batches):
        for pdf in batches:
            x = np.column_stack([np.ones(len(pdf)), pdf[names].to_numpy(dtype=np.float64)])
            yield pd.DataFrame({"e": pdf[y].to_numpy(dtype=np.float64) - x @ beta, "h": ((x @ inv) * x).sum(axis=1)})

    r = df.select(y, *names).mapInPandas(residuals, "e double, h double")
    denom = (1.0 - trace / n) ** 2
    return r.agg(
        F.avg((F.col("e") / (1 - F.col("h"))) ** 2).alias("loo_mse"),
        (F.avg(F.col("e") ** 2) / F.lit(denom) if denom > 0 else F.lit(None).cast("double")).alias("gcv"),
        F.lit(trace).alias("dof"),
    )


def fold_grams(df: DataFrame, y: str, xs: Sequence[str], fold: str) -> dict:
    """Per-fold (XᵀX, Xᵀy, yᵀy, n) with an intercept column from ONE scan: every partition
    emits one partial Gram per fold it holds, a grouped sum merges them."""
    import pandas as pd

    names = list(xs) + [y]
    q = len(names)  # intercept + xs, then y last
    src = df.select(F.col(fold).cast("long").alias("_fold"), *[F.col(c).cast("double").alias(c) for c in names])

    def part(it):
        acc: dict = {}
        for pdf in it:
            for f, g in pdf.groupby("_fold"):
                x = np.column_stack([np.ones(len(g)), g[names].to_numpy(dtype=np.float64)])
                m, n = acc.get(f, (np.zeros((q + 1, q + 1)), 0))
                acc[f] = (m + x.T @ x, n + len(g))
        for f, (m, n) in acc.items():
            ii, jj = np.meshgrid(np.arange(q + 1), np.arange(q + 1), indexing="ij")
            yield pd.DataFrame({"fold": np.full(m.size, f, dtype=np.int64), "i": ii.ravel().astype(np.int32),
                                "j": jj.ravel().astype(np.int32), "s": m.ravel(), "n": np.full(m.size, n, dtype=np.int64)})

    tot = src.mapInPandas(part, "fold long, i int, j int, s double, n long").groupBy("fold", "i", "j").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")).collect()  # folds × (p+2)² numbers
    mats: dict = {}
    for r in tot:
        m, n = mats.get(r["fold"], (np.zeros((q + 1, q + 1)), 0))
        m[r["i"], r["j"]] = r["s"]
        mats[r["fold"]] = (m, r["n"])
    return {f: (m[:q, :q], m[:q, q], float(m[q, q]), int(n)) for f, (m, n) in mats.items()}


def cv_ridge(df: DataFrame, y: str, xs: Sequence[str], fold: str, lambdas: Sequence[float]) -> list[dict]:
    """M24 + M21: K-fold CV error per λ from fold Grams (train Gram = total − fold), and the
    one-SE choice: the largest λ whose error is within one standard error of the best."""
    g = fold_grams(df, y, xs, fold)
    tot_xtx = sum(v[0] for v in g.values())
    tot_xty = sum(v[1] for v in g.values())
    rows = []
    for lam in lambdas:
        errs = []
        for f, (xtx_f, xty_f, yty_f, n_f) in g.items():
            beta = solve(tot_xtx - xtx_f, tot_xty - xty_f, lam)
            errs.append(sse_from_gram(xtx_f, xty_f, yty_f, beta) / n_f)
        e = np.asarray(errs)
        rows.append({"lambda": float(lam), "cv_mse": float(e.mean()), "se": float(e.std(ddof=1) / np.sqrt(len(e)))})
    best = min(rows, key=lambda r: r["cv_mse"])
    limit = best["cv_mse"] + best["se"]
    chosen = max(r["lambda"] for r in rows if r["cv_mse"] <= limit)
    for r in rows:
        r["is_best"] = r["lambda"] == best["lambda"]
        r["one_se_choice"] = r["lambda"] == chosen
    return rows


def stepwise(df: DataFrame, y: str, xs: Sequence[str], direction: str = "forward", n_max: int | None = None) -> list[dict]:
    """M5: forward or backward selection by residual sum of squares, all from one Gram.

    Each step also reports GCV = (RSS/n) / (1 − d/n)² with d = terms + 1.
    """
    xtx, xty, yty, n = gram(df, y, xs)
    names = list(xs)
    n_max = n_max or len(names)

    def rss(idx):
        cols = [0] + [i + 1 for i in idx]
        a, b = xtx[np.ix_(cols, cols)], xty[cols]
        beta = np.linalg.pinv(a) @ b
        return sse_from_gram(a, b, yty, beta)

    steps = []
    current = [] if direction == "forward" else list(range(len(names)))
    while True:
        if direction == "forward":
            if len(current) >= n_max:
                break
            cands = [i for i in range(len(names)) if i not in current]
            if not cands:
                break
            best = min(cands, key=lambda i: (rss(current + [i]), i))
            current = current + [best]
            changed = names[best]
        else:
            if len(current) <= 1:
                break
            best = min(current, key=lambda i: (rss([c for c in current if c != i]), i))
            current = [c for c in current if c != best]
            changed = names[best]
        r = rss(current)
        d = len(current) + 1
        steps.append({"step": len(steps) + 1, "term": changed, "terms": len(current), "rss": r,
                      "gcv": (r / n) / (1 - d / n) ** 2})
    return steps


def pca(df: DataFrame, k: int, vec: str = "v") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """M6: top-k eigenpairs of the sample covariance (p×p on the driver); each
    component's sign makes its largest-magnitude entry positive."""
    from lodestar.operators.moments import covariance_numpy

    mean, cov, _ = covariance_numpy(df, vec)
    w, v = np.linalg.eigh(cov)
    order = np.argsort(w)[::-1][:k]
    vals, vecs = w[order], v[:, order]
    for j in range(vecs.shape[1]):
        if vecs[np.argmax(np.abs(vecs[:, j])), j] < 0:
            vecs[:, j] = -vecs[:, j]
    return mean, vals, vecs


def project(df: DataFrame, mean: np.ndarray, vecs: np.ndarray, vec: str = "v", out: str = "pcs") -> DataFrame:
    """Scores on the components, (v − mean) · V, one product for a batch of rows."""
    from lodestar.operators.blocks import matrix

    schema = df.withColumn(out, F.lit(None).cast("array<double>")).schema

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{out: list((matrix(pdf[vec]) - mean) @ vecs)})

    return df.mapInPandas(run, schema)


def cross_validate(folds: dict, fit: Callable, loss: Callable) -> list[float]:
    """The loss of each fold under the fit of all others.

    ``folds`` holds a summary for each fold that adds up (a Gram, counts, ...) as a tuple of arrays;
    ``fit(summary)`` gives a model from the sum of the other folds and ``loss(model, summary)`` its loss
    on one.  The rows are read once, for the summaries.
    """
    total = [sum(parts) for parts in zip(*folds.values())]
    return [loss(fit(tuple(t - p for t, p in zip(total, own))), own) for own in folds.values()]


def grid_search(params: Sequence, score: Callable) -> list[dict]:
    """``score`` at every parameter; the smallest is marked, the first of equals."""
    rows = [{"param": p, "score": float(score(p))} for p in params]
    best = min(range(len(rows)), key=lambda i: rows[i]["score"]) if rows else -1
    return [r | {"is_best": i == best} for i, r in enumerate(rows)]


def gram_ridge_loss(lam: float = 0.0) -> tuple[Callable, Callable]:
    """(fit, loss) for ``cross_validate`` over fold Grams (XᵀX, Xᵀy, yᵀy, n): ridge and its mean squared error."""
    return (lambda g: solve(g[0], g[1], lam)), (lambda beta, g: sse_from_gram(g[0], g[1], g[2], beta) / g[3])


def best_subset_size(df: DataFrame, y: str, xs: Sequence[str], fold: str, direction: str = "forward") -> list[dict]:
    """M5: cross-validated error of each number of terms; every fold runs its own stepwise search on the others' Gram."""
    folds = fold_grams(df, y, xs, fold)
    rows = []
    for size in range(1, len(xs) + 1):
        def fit(g, size=size):
            order = _search(g[0], g[1], g[2], len(xs), direction, size)
            cols = [0, *(i + 1 for i in order)]
            beta = np.zeros(len(xs) + 1)
            beta[cols] = np.linalg.pinv(g[0][np.ix_(cols, cols)]) @ g[1][cols]
            return beta

        errs = cross_validate(folds, fit, gram_ridge_loss()[1])
        rows.append({"terms": size, "cv_mse": float(np.mean(errs))})
    best = min(rows, key=lambda r: r["cv_mse"])["terms"]
    return [r | {"is_best": r["terms"] == best} for r in rows]


def _search(xtx: np.ndarray, xty: np.ndarray, yty: float, p: int, direction: str, size: int) -> list[int]:
    """Term numbers after a forward or backward search down or up to ``size`` terms."""
    def rss(idx):
        cols = [0, *(i + 1 for i in idx)]
        a, b = xtx[np.ix_(cols, cols)], xty[cols]
        return sse_from_gram(a, b, yty, np.linalg.pinv(a) @ b)

    if direction == "forward":
        chosen: list[int] = []
        while len(chosen) < size:
            chosen.append(min((i for i in range(p) if i not in chosen), key=lambda i: (rss([*chosen, i]), i)))
        return chosen
    chosen = list(range(p))
    while len(chosen) > size:
        out = min(chosen, key=lambda i: (rss([c for c in chosen if c != i]), i))
        chosen = [c for c in chosen if c != out]
    return chosen


def _components(ztz: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, v = np.linalg.eigh(ztz)
    order = np.argsort(w)[::-1]
    return w[order], v[:, order]


def pc_regression(df: DataFrame, y: str, xs: Sequence[str], fold: str) -> list[dict]:
    """M7: regression on the first k principal components for every k; press is the summed held-out squared error.

    Everything follows from one Gram per fold: the complement's Gram is centred and scaled, its
    eigenvectors are the components, and the fit is turned back to the columns before it meets the fold.
    """
    folds = fold_grams(df, y, xs, fold)
    total = [sum(parts) for parts in zip(*folds.values())]

    def fit(g, k):
        xtx, xty, _, n = g
        mean, my = xtx[0, 1:] / n, xty[0] / n
        cov = xtx[1:, 1:] - n * np.outer(mean, mean)
        sd = np.sqrt(np.where(np.diag(cov) > 0, np.diag(cov), 1.0))
        w, v = _components(cov / np.outer(sd, sd))
        zty = (xty[1:] - n * mean * my) / sd
        keep = [j for j in range(k) if w[j] > 1e-12]
        slope = v[:, keep] @ ((v[:, keep].T @ zty) / w[keep]) / sd
        return np.r_[my - slope @ mean, slope]

    rows = []
    for k in range(1, len(xs) + 1):
        press = sum(cross_validate(folds, lambda g, k=k: fit(g, k), lambda b, g: sse_from_gram(g[0], g[1], g[2], b)))
        beta = fit(total, k)
        rows.append({"k": k, "press": float(press), "train_mse": sse_from_gram(*total[:3], beta) / total[3], "coefs": beta.tolist()})
    best = min(rows, key=lambda r: r["press"])["k"]
    return [r | {"is_best": r["k"] == best} for r in rows]


def spectral_shrinkage(df: DataFrame, y: str, xs: Sequence[str], how: str, amount: float) -> np.ndarray:
    """M8: coefficients [intercept, slopes...] after shrinking in the eigenbasis of the standardized columns.

    The coefficients on the components, in units where each component has unit length, are cut
    ("hard"), moved towards 0 ("soft"), or scaled by 1 / (1 + amount² / a²) ("ratio"), then rotated
    back to the columns.
    """
    ztz, zty, _, mean, sd, my, n = centred_gram(df, y, xs)
    w, v = _components(ztz)
    root = np.sqrt(np.where(w > 1e-12, w, np.inf))
    a = (v.T @ zty) / root
    if how == "hard":
        a = np.where(np.abs(a) > amount, a, 0.0)
    elif how == "soft":
        a = np.sign(a) * np.maximum(np.abs(a) - amount, 0.0)
    elif how == "ratio":
        a = np.divide(a ** 3, a ** 2 + amount ** 2, out=np.zeros_like(a), where=a != 0)
    else:
        raise ValueError(how)
    slope = v @ (a / root) / sd
    return np.r_[my - slope @ mean, slope]
