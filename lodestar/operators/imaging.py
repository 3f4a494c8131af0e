"""Grid/tensor operators: patches, set kernels, pyramid max pooling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.blocks import matrix

from lodestar.functions.vectors import rbf, window_patch


def patches(df: DataFrame, vec: str, width: int, p: int = 5, stride: int = 2, inclusive: bool = False,
            keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
    """Every p×p window of a row-major width×width grid, one row per window.

    Starts run ``0, stride, ...`` while ``start < width − p`` (``<=`` with
    ``inclusive=True``); the centre is ``start + (p − 1) / 2`` on both axes.
    """
    last = width - p if inclusive else width - p - 1
    starts = F.sequence(F.lit(0), F.lit(last), F.lit(stride)) if last >= 0 else F.array().cast("array<int>")
    g = df.select(*keep, F.col(vec).cast("array<double>").alias("_g"))
    g = g.withColumn("pr", F.explode(starts)).withColumn("pc", F.explode(starts))
    half = (p - 1) / 2.0
    return g.select(
        *keep, "pr", "pc",
        (F.col("pr") + half).alias("centre_r"), (F.col("pc") + half).alias("centre_c"),
        window_patch("_g", width, F.col("pr"), F.col("pc"), p).alias("patch"),
    )


def set_kernel(pairs: DataFrame, pa: DataFrame, pb: DataFrame, sigma: float,
               spatial_sigma: float | None = None) -> DataFrame:
    """Σ over patch pairs of k(p, q) for each requested (left, right) pair of grids.

    ``pairs(left_id, right_id)`` names the grid pairs; ``pa``/``pb`` are patch
    tables keyed by ``vec_id``.  The spatial variant multiplies an RBF of the
    patch centres.  Work is linear in (pairs × patches per grid).
    """
    a = pa.select(F.col("vec_id").alias("left_id"), F.col("patch").alias("pa"),
                  F.col("centre_r").alias("ra"), F.col("centre_c").alias("ca"))
    b = pb.select(F.col("vec_id").alias("right_id"), F.col("patch").alias("pb"),
                  F.col("centre_r").alias("rb"), F.col("centre_c").alias("cb"))
    j = pairs.join(a, "left_id").join(b, "right_id")
    k = rbf("pa", "pb", sigma)
    if spatial_sigma is not None:
        d2 = (F.col("ra") - F.col("rb")) ** 2 + (F.col("ca") - F.col("cb")) ** 2
        k = k * F.exp(-d2 / (spatial_sigma ** 2))
    return j.groupBy("left_id", "right_id").agg(F.sum(k).alias("kernel"), F.count("*").alias("patch_pairs"))


def adaptive_bins(n: int, k: int) -> list[tuple[int, int]]:
    """Adaptive pooling windows: bin i covers floor(i·n/k) .. ceil((i+1)·n/k) (end exclusive)."""
    return [((i * n) // k, -((-(i + 1) * n) // k)) for i in range(k)]


def pyramid_max_pool(df: DataFrame, vec: str, c: int, w: int, h: int, box: tuple[str, str, str, str],
                     levels: tuple[int, ...] = (1, 3, 6)) -> DataFrame:
    """crop a C×W×H tensor to box (x0, y0, x1, y1; end exclusive) and max-pool each level.

    Output ``pooled`` has C·Σ level² values ordered level, channel, bin-x, bin-y
    (the concatenation of each level's flattened C×k×k map).  Rows of a batch with the same box are
    pooled together as one array.
    """
    schema = df.withColumn("pooled", F.lit(None).cast("array<double>")).schema

    def run(batches):
        for pdf in batches:
            t = matrix(pdf[vec]).reshape(len(pdf), c, w, h)
            out = [None] * len(pdf)
            for (x0, y0, x1, y1), rows in pdf.reset_index(drop=True).groupby(list(box)).indices.items():
                crop = t[rows][:, :, int(x0):int(x1), int(y0):int(y1)]
                maps = []
                for k in levels:
                    cells = [crop[:, :, xa:xb, ya:yb].max(axis=(2, 3)) for xa, xb in adaptive_bins(crop.shape[2], k)
                             for ya, yb in adaptive_bins(crop.shape[3], k)]
                    maps.append(np.stack(cells, axis=2).reshape(len(rows), -1))
                for row, pooled in zip(rows, np.concatenate(maps, axis=1)):
                    out[row] = pooled
            yield pdf.assign(pooled=out)

    return df.mapInPandas(run, schema)
