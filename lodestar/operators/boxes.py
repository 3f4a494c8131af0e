"""Bounding boxes: IoU, projection onto the feature grid, proposal labelling.

Boxes are ``(x, y, w, h)`` integer columns with the inclusive-pixel
convention: a box covers x..x+w, so its area is (w + 1)(h + 1).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators import blocks
from lodestar.session import cut_lineage


def _shared_pixels(start_a: Column, size_a: Column, start_b: Column, size_b: Column) -> Column:
    """Pixels that two inclusive ranges have in common along one axis."""
    end = F.least(start_a + size_a, start_b + size_b)
    return F.greatest(F.lit(0), end - F.greatest(start_a, start_b) + 1)


def iou(a: tuple[Column, Column, Column, Column], b: tuple[Column, Column, Column, Column]) -> Column:
    """shared pixels over all pixels of two boxes (0 when they do not meet)."""
    shared = (_shared_pixels(a[0], a[2], b[0], b[2]) * _shared_pixels(a[1], a[3], b[1], b[3])).cast("double")
    pixels = (a[2] + 1) * (a[3] + 1) + (b[2] + 1) * (b[3] + 1)
    return shared / (pixels - shared)


def iou_sql(a: str, b: str) -> str:
    """``iou`` in the oracle's dialect for boxes of two table aliases."""
    def axis(start, size):
        return (f"greatest(0, least({a}.{start} + {a}.{size}, {b}.{start} + {b}.{size}) - greatest({a}.{start}, {b}.{start}) + 1)")

    shared = f"CAST({axis('x', 'w')} * {axis('y', 'h')} AS DOUBLE)"
    return f"({shared} / (({a}.w + 1) * ({a}.h + 1) + ({b}.w + 1) * ({b}.h + 1) - {shared}))"


def iou_np(p: np.ndarray, t: np.ndarray) -> np.ndarray:
    """F7 on arrays: proposals p (n×4) against truth t (m×4) → n×m."""
    p, t = p.astype(np.float64)[:, None, :], t.astype(np.float64)[None, :, :]
    ends = np.minimum(p[..., :2] + p[..., 2:], t[..., :2] + t[..., 2:])
    shared = np.clip(ends - np.maximum(p[..., :2], t[..., :2]) + 1, 0, None).prod(axis=-1)
    return shared / ((p[..., 2:] + 1).prod(axis=-1) + (t[..., 2:] + 1).prod(axis=-1) - shared)


# fixed values of the feature grid: input pixels, pixels between cell centres, cells
GRID_INPUT, GRID_STRIDE, GRID_CELLS = 224, 16, 13


def _grid_range(start: Column, size: Column, full: Column, pixels: int) -> tuple[Column, Column]:
    """First and one-past-last grid cell of a range along one axis, scaled to ``pixels`` input pixels."""
    def nearest(scaled: Column) -> Column:
        cell = F.floor((scaled + 1 + GRID_STRIDE // 2) / F.lit(float(GRID_STRIDE)))
        return F.greatest(F.lit(1), F.least(cell, F.lit(GRID_CELLS))).cast("int")

    return nearest(F.floor(start * pixels / full)) - 1, nearest(F.ceil((start + size) * pixels / full))


def project_box(x: Column, y: Column, w: Column, h: Column, img_w: Column, img_h: Column, size: int = GRID_INPUT) -> Column:
    """F8: box → (x0, y0, x1, y1) on the conv grid; start inclusive, end exclusive."""
    (x0, x1), (y0, y1) = _grid_range(x, w, img_w, size), _grid_range(y, h, img_h, size)
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def label_proposals(proposals: DataFrame, truth: DataFrame, keys: list[str], box_id: str = "box_id",
                    min_iou: float = 0.5, pair_limit: int = blocks.BLOCK_ROWS * 64) -> DataFrame:
    """Each proposal once, with its best IoU against truth boxes sharing ``keys``
    and ``label = 1`` when that IoU exceeds ``min_iou`` (no truth box → 0).

    A proposal meets the list of its keys' truth boxes, so proposals that are dealt out by ``keys`` stay where they are; keys
    whose proposal × truth count exceeds ``pair_limit`` are cut into sub-blocks (by a hash of each box) and reduced in NumPy;
    both do the same arithmetic.
    """
    cols = ["x", "y", "w", "h"]
    own = tuple(F.col(c) for c in cols)
    met = reduce(and_, [F.col(k).isNotNull() for k in keys])
    whole = proposals.select(box_id, *[c for c in proposals.columns if c != box_id])
    p = whole.where(met)
    t = truth.where(met).select(*[F.col(k).alias(k) for k in keys], *[F.col(c).alias("t_" + c) for c in cols])
    n_left = p.groupBy(*[F.col(k).alias(k) for k in keys]).agg(F.count("*").alias("n_left"))
    n_right = t.groupBy(*[F.col(k).alias(k) for k in keys]).agg(F.count("*").alias("n_right"))
    # long truth lists are hot too
    hot = cut_lineage(n_right.join(n_left, keys, "left").where(F.greatest(F.coalesce("n_left", F.lit(0)), F.lit(1)) * F.col("n_right") > pair_limit)
                      .withColumn("n_left", F.coalesce("n_left", F.lit(0))))
    any_hot = hot.limit(1).count() > 0
    hot_keys = hot.select(*[F.col(k).alias(k) for k in keys])
    p_cold, t_cold = (d.join(hot_keys, keys, "left_anti") if any_hot else d for d in (p, t))
    lists = t_cold.groupBy(*keys).agg(F.collect_list(F.struct(*["t_" + c for c in cols])).alias("_truth"))
    out = p_cold.join(lists, keys, "left").withColumn(
        "max_iou", F.array_max(F.transform("_truth", lambda b: iou(own, tuple(b["t_" + c] for c in cols))))).select(*p.columns, "max_iou")
    if any_hot:
        def fn(pp: pd.DataFrame, tp: pd.DataFrame) -> pd.DataFrame:
            m = iou_np(pp[cols].to_numpy(), tp[["t_" + c for c in cols]].to_numpy())
            return pd.DataFrame({"_pid": pp["_pid"].to_numpy(), "max_iou": m.max(axis=1)})

        p_hot, both = p.join(hot_keys, keys), hot.where("n_left > 0")
        best = blocks.cogroup_grouped_blocks(
            p_hot.select(*[F.col(k).alias(k) for k in keys], F.col(box_id).alias("_pid"), *cols),
            t.withColumn("_tid", F.xxhash64(*t.columns)), keys, both,
            "_pid", "_tid", fn, f"_pid {proposals.schema[box_id].dataType.simpleString()}, max_iou double")
        best = best.groupBy(F.col("_pid").alias(box_id)).agg(F.max("max_iou").alias("max_iou"))
        out = out.unionByName(p_hot.join(best, box_id, "left").select(*p.columns, "max_iou"))
    out = out.unionByName(whole.where(~met).withColumn("max_iou", F.lit(None).cast("double")))
    return out.withColumn("max_iou", F.coalesce("max_iou", F.lit(0.0))).withColumn(
        "label", (F.col("max_iou") > min_iou).cast("int"))


def iou_summary(proposals: DataFrame, truth: DataFrame, keys: list[str], box_id: str = "box_id", min_iou: float = 0.5,
                pair_limit: int = blocks.BLOCK_ROWS * 64) -> DataFrame:
    """(pairs, over, total) of the IoU of all proposals with all truth boxes sharing ``keys``: their number, those above ``min_iou``, the sum.

    An image with more than ``pair_limit`` pairs is cut into sub-blocks that give three numbers each.
    """
    cols = ["x", "y", "w", "h"]
    p = proposals.select(*[F.col(k).alias(k) for k in keys], F.col(box_id).alias("_pid"), *cols)
    t = truth.select(*[F.col(k).alias(k) for k in keys], F.xxhash64(*keys, *cols).alias("_tid"), *[F.col(c).alias("t_" + c) for c in cols])
    p_cold, t_cold, hot = blocks.split_hot(p, t, keys, pair_limit)
    one = p_cold.join(t_cold, keys).select(iou(tuple(F.col(c) for c in cols), tuple(F.col("t_" + c) for c in cols)).alias("iou"))
    cold = one.agg(F.count(F.lit(1)).alias("pairs"), F.sum((F.col("iou") > min_iou).cast("long")).alias("over"), F.sum("iou").alias("total"))

    def fn(pp: pd.DataFrame, tp: pd.DataFrame) -> pd.DataFrame:
        m = iou_np(pp[cols].to_numpy(), tp[["t_" + c for c in cols]].to_numpy())
        return pd.DataFrame({"pairs": [m.size], "over": [int((m > min_iou).sum())], "total": [float(m.sum())]})

    parts = blocks.cogroup_grouped_blocks(p.join(hot.select(*keys), keys), t.join(hot.select(*keys), keys), keys, hot, "_pid", "_tid", fn,
                                          "pairs long, over long, total double")
    return cold.unionByName(parts).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pairs", "over", "total")])


def attach_features(boxes: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """N:1 equi-join of boxes to their image's features (the planner broadcasts a small side)."""
    return boxes.join(features, key)
