"""Ordered event logs: running statistics, stable runs, training-curve helpers, arm posteriors
(W4–W7, W10, W12, A19, B1, B2).

Every ordering over the whole log goes through ``prefix.running_totals`` (range
by range); shifted comparisons use an equi-join on the step number instead
of ``lag`` over an unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.operators.prefix import running_totals


def running_mean(log: DataFrame, order: Sequence[tuple[str, bool]], value: str) -> DataFrame:
    """Step number and mean of ``value`` over all steps so far."""
    r = running_totals(log, order, {"step": F.lit(1).cast("long"), "_cum": F.col(value).cast("double")})
    return r.withColumn("running_mean", F.col("_cum") / F.col("step")).drop("_cum")


def running_share(log: DataFrame, order: Sequence[tuple[str, bool]], arm: str, arms: Sequence[str]) -> DataFrame:
    """For each step, the share of steps so far that pulled each arm → (step, arm, share)."""
    sums = {"step": F.lit(1).cast("long")}
    for i, a in enumerate(arms):
        sums[f"_n{i}"] = (F.col(arm) == a).cast("long")
    r = running_totals(log, order, sums)
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias("arm"), (F.col(f"_n{i}") / F.col("step")).alias("share"))
                                  for i, a in enumerate(arms)]))
    return r.select("step", stacked.alias("s")).select("step", "s.arm", "s.share")


def stable_run(shares: DataFrame, threshold: float, length: int, min_index: int) -> DataFrame:
    """Per arm, the first 0-based index i (> min_index) with share > threshold at i and at
    the ``length`` previous steps; reports i − length (the start of the run).

    Steps of an arm that follow each other above the threshold share their running count of failures,
    so each run is one group of (arm, count) and only its first and last step are needed.
    """
    x = shares.withColumn("_bad", (F.col("share") <= threshold).cast("long"))
    c = running_totals(x, [("step", True)], {"_c": F.col("_bad")}, partition_by=["arm"])
    runs = c.where("_bad = 0").groupBy("arm", "_c").agg(F.min("step").alias("first"), F.max("step").alias("last"))
    hit = F.greatest(F.col("first") + length, F.lit(min_index + 2))
    return runs.withColumn("hit", hit).where("hit <= last").groupBy("arm").agg((F.min("hit") - 1 - length).alias("run_start"))


def first_difference_noise(series: DataFrame, t: str, y: str) -> DataFrame:
    """σ̂² = Σ (y_t − y_prev)² / (2 (n − 1)) over consecutive rows (D15), with the raw sum and n."""
    from lodestar.operators.prefix import global_row_number

    s = global_row_number(series.select(t, y), [(t, True)], "_pos")
    prev = s.select((F.col("_pos") + 1).alias("_pos"), F.col(y).alias("_prev"))
    d = s.join(prev, "_pos").select(((F.col(y) - F.col("_prev")) ** 2).alias("d2"))
    n = series.count()  # one scalar
    return d.agg(F.sum("d2").alias("sum_sq_diff"), (F.sum("d2") / (2.0 * (n - 1))).alias("noise_var"),
                 F.lit(n).cast("long").alias("n"))


def metric_every(history: DataFrame, every: int, step: str, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """Keep steps with step % every = 0 and the best metric so far."""
    kept = history.where(F.col(step) % every == 0)
    return running_totals(kept, [(step, True)], {"best_so_far": F.col(metric)}, partition_by=by, how="max")


def train_test_gap(history: DataFrame, bucket: int, step: str, split: str, metric: str) -> DataFrame:
    """Mean metric per step bucket for each split side by side, and their gap."""
    b = history.withColumn("bucket", (F.col(step) / bucket).cast("long"))
    p = b.groupBy("bucket").pivot(split, ["train", "val"]).agg(F.avg(metric))
    return p.withColumn("gap", F.col("val") - F.col("train"))


def arm_posteriors(log: DataFrame, arm: str, reward: str) -> DataFrame:
    """B1: Beta(1 + wins, 1 + losses) per arm, its mean and the number of pulls."""
    g = log.groupBy(arm).agg(F.sum(F.col(reward).cast("long")).alias("wins"), F.count("*").alias("pulls"))
    return g.select(
        arm, "pulls", (F.col("wins") + 1).alias("alpha"), (F.col("pulls") - F.col("wins") + 1).alias("beta"),
    ).withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))


#: Panels between the ends of the density, and the nodes and weights of each.
_PANELS = 48
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(16)
#: Where the density has fallen by this factor (as a logarithm) it is cut off.
_DROP = 80.0


def _log_density(a: np.ndarray, b: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Logarithm of the density of logit(t) − logit(mode) for t from Beta(a, b), relative to its top.

    On this scale the density is log-concave and smooth for all a, b > 0, and the two large terms cancel
    before they are rounded, so a billion pulls are as good as ten.
    """
    p = a / (a + b)
    with np.errstate(over="ignore"):
        far = v > 30.0  # log(1 + p(e^v − 1)) without the exponential
        grown = np.where(far, v + np.log(p + np.exp(-np.abs(v)) * (1 - p)), np.log1p(p * np.expm1(np.minimum(v, 30.0))))
    return a * v - (a + b) * grown


def _ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the density has fallen by ``_DROP`` on each side of its top, by doubling and halving."""
    out = []
    for side in (-1.0, 1.0):
        near, far = np.zeros_like(a), np.full_like(a, 1.0) / np.sqrt(a + b)
        while (low := _log_density(a, b, side * far) > -_DROP).any():
            near, far = np.where(low, far, near), np.where(low, 2 * far, far)
        for _ in range(40):
            mid = (near + far) / 2
            high = _log_density(a, b, side * mid) > -_DROP
            near, far = np.where(high, mid, near), np.where(high, far, mid)
        out.append(side * far)
    return out[0], out[1]


def _area(a: np.ndarray, b: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Area under the density from ``start`` to ``stop``; all arguments have one shape."""
    half = (stop - start) / 2
    v = (start + half)[..., None] + half[..., None] * _NODES
    return half * (np.exp(_log_density(a[..., None], b[..., None], v)) @ _WEIGHTS)


def _panels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edges, area up to each edge as a share of the whole) of every density."""
    lo, hi = _ends(a, b)
    edges = lo[:, None] + (hi - lo)[:, None] * np.linspace(0, 1, _PANELS + 1)
    wide = lambda x: np.broadcast_to(x[:, None], (len(x), _PANELS))
    area = _area(wide(a), wide(b), edges[:, :-1], edges[:, 1:])
    upto = np.concatenate([np.zeros((len(a), 1)), np.cumsum(area, axis=1)], axis=1)
    return edges, upto


def beta_cdf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Share of Beta(a, b) below x, by Gauss-Legendre panels on the logit scale; x inside (0, 1)."""
    a, b, x = np.broadcast_arrays(*(np.asarray(z, dtype=float) for z in (a, b, x)))
    edges, upto = _panels(a, b)
    v = np.clip(np.log(x) - np.log1p(-x) - (np.log(a) - np.log(b)), edges[:, 0], edges[:, -1])
    at = np.minimum((edges[:, 1:] < v[:, None]).sum(axis=1), _PANELS - 1)
    row = np.arange(len(a))
    return np.clip((upto[row, at] + _area(a, b, edges[row, at], v)) / upto[:, -1], 0.0, 1.0)


def beta_quantile(a: np.ndarray, b: np.ndarray, q: float, iters: int = 60) -> np.ndarray:
    """Quantile of Beta(a, b): the panel in which the share is reached, then bisection inside it."""
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    edges, upto = _panels(a, b)
    need, row = q * upto[:, -1], np.arange(len(a))
    at = np.clip((upto[:, 1:] < need[:, None]).sum(axis=1), 0, _PANELS - 1)
    start = edges[row, at]
    lo, hi = start.copy(), edges[row, at + 1]
    for _ in range(iters):
        mid = (lo + hi) / 2
        below = upto[row, at] + _area(a, b, start, mid) < need
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    v = (lo + hi) / 2
    return 1 / (1 + b / a * np.exp(-v))


def arm_intervals(posteriors: DataFrame, lower: float = 0.025, upper: float = 0.975) -> DataFrame:
    """B2: central credible interval of each arm's Beta posterior (Arrow UDF, one row per arm)."""

    @F.pandas_udf("double")
    def q_lo(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(beta_quantile(a.to_numpy(float), b.to_numpy(float), lower))

    @F.pandas_udf("double")
    def q_hi(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(beta_quantile(a.to_numpy(float), b.to_numpy(float), upper))

    return posteriors.withColumn("lower", q_lo("alpha", "beta")).withColumn("upper", q_hi("alpha", "beta"))
