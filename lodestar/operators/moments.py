"""Column statistics, covariance and Gram matrices, standardization.

Matrix-valued aggregates use the partial/final pattern: every partition
reduces its rows to a p×p block with NumPy (Arrow batches in, one small
frame out) and a grouped ``sum`` merges the blocks.  Only p² numbers ever
reach the driver, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.blocks import matrix


def column_moments(df: DataFrame, vec: str = "v", by: Sequence[str] = ()) -> DataFrame:
    """A1: per vector position mean, sample/population variance, sd, min, max."""
    ex = df.select(*by, F.posexplode(F.col(vec)).alias("pos", "x"))
    return ex.groupBy(*by, "pos").agg(
        F.avg("x").alias("mean"), F.var_samp("x").alias("var_samp"), F.var_pop("x").alias("var_pop"),
        F.stddev_samp("x").alias("sd"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.count("x").alias("n"),
    )


def mean_sd_arrays(df: DataFrame, vec: str = "v") -> DataFrame:
    """A1 in array form: one row with mean / sd arrays (p doubles each).

    Uses ``Summarizer`` — a single tree aggregation, no explode."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    s = Summarizer.metrics("mean", "variance", "count")
    r = df.select(s.summary(array_to_vector(F.col(vec))).alias("s")).select(
        vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("var"), F.col("s.count").alias("n")
    )
    return r.select("mean", F.transform("var", lambda x: F.sqrt(x)).alias("sd"), "n")


def _partial_gram(cols: list[str], center: list[float] | None, with_vec: str | None):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = None
        n = 0
        for pdf in it:
            if with_vec is not None:
                x = matrix(pdf[with_vec])
            else:
                x = pdf[cols].to_numpy(dtype=np.float64)
            if x.size == 0:
                continue
            if center is not None:
                x = x - np.asarray(center)[None, :]
            g = x.T @ x
            acc = g if acc is None else acc + g
            n += x.shape[0]
        if acc is None:
            return
        p = acc.shape[0]
        ii, jj = np.meshgrid(np.arange(p), np.arange(p), indexing="ij")
        yield pd.DataFrame({"i": ii.ravel().astype(np.int32), "j": jj.ravel().astype(np.int32),
                            "s": acc.ravel(), "n": np.full(p * p, n, dtype=np.int64)})

    return run


def gram_entries(df: DataFrame, cols: Sequence[str] | None = None, vec: str | None = None,
                 center: Sequence[float] | None = None) -> DataFrame:
    """Σ x xᵀ over all rows as (i, j, s, n) — partial blocks per partition, then a grouped sum."""
    if vec is not None:
        src = df.select(F.col(vec).cast("array<double>").alias(vec))
        fn = _partial_gram([], list(center) if center is not None else None, vec)
    else:
        src = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
        fn = _partial_gram(list(cols), list(center) if center is not None else None, None)
    part = src.mapInPandas(fn, "i int, j int, s double, n long")
    return part.groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def covariance_matrix(df: DataFrame, vec: str = "v") -> DataFrame:
    """A2: sample covariance (n − 1) as (i, j, cov); centred on the exact means first."""
    means = mean_sd_arrays(df, vec).first()["mean"]
    g = gram_entries(df, vec=vec, center=list(means))
    return g.select("i", "j", (F.col("s") / (F.col("n") - 1)).alias("cov"))


def covariance_numpy(df: DataFrame, vec: str = "v") -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, cov, n) as NumPy arrays on the driver — p×p only."""
    st = mean_sd_arrays(df, vec).first()
    means = np.asarray(st["mean"])
    g = gram_entries(df, vec=vec, center=list(means)).collect()
    p = len(means)
    cov = np.zeros((p, p))
    n = 0
    for r in g:
        cov[r["i"], r["j"]] = r["s"]
        n = r["n"]
    return means, cov / (n - 1), int(n)


def gram(df: DataFrame, y: str, xs: Sequence[str], intercept: bool = True) -> tuple[np.ndarray, np.ndarray, float, int]:
    """A3: (XᵀX, Xᵀy, yᵀy, n) on the driver; X gets a leading 1 column when ``intercept``."""
    cols = list(xs)
    src = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(y).cast("double").alias("_y"))
    if intercept:
        src = src.withColumn("_one", F.lit(1.0))
        cols = ["_one"] + cols
    allc = cols + ["_y"]
    entries = gram_entries(src, cols=allc).collect()
    p = len(allc)
    m = np.zeros((p, p))
    n = 0
    for r in entries:
        m[r["i"], r["j"]] = r["s"]
        n = r["n"]
    q = len(cols)
    return m[:q, :q], m[:q, q], float(m[q, q]), int(n)


def standardize(df: DataFrame, cols: Sequence[str], how: str = "sd", measured_on: DataFrame | None = None) -> DataFrame:
    """Standardize columns with statistics from ``measured_on`` (the training split).

    how = "sd": (x−mean)/sd; "range": (x−mean)/(max−min); "var": (x−mean)/var with 0→1;
    "mean": x/mean with 0→1.  The statistics are one row, computed once and
    inlined as literals (2–4 numbers per column).
    """
    src = measured_on if measured_on is not None else df
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__sd"),
                 F.var_samp(c).alias(f"{c}__var"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    st = src.agg(*aggs).first().asDict()
    out = df
    for c in cols:
        m, sd, var = st[f"{c}__mean"], st[f"{c}__sd"], st[f"{c}__var"]
        lo, hi = st[f"{c}__min"], st[f"{c}__max"]
        x = F.col(c)
        if how == "sd":
            e = (x - F.lit(m)) / F.lit(sd if sd else 1.0)
        elif how == "range":
            e = (x - F.lit(m)) / F.lit((hi - lo) if hi != lo else 1.0)
        elif how == "var":
            e = (x - F.lit(m)) / F.lit(var if var else 1.0)
        elif how == "mean":
            e = x / F.lit(m if m else 1.0)
        else:
            raise ValueError(how)
        out = out.withColumn(c, e)
    return out
