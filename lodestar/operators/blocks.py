"""Block-pair execution for operators that compare every left row with every right row.

Rows are hashed into ``n_left`` × ``n_right`` blocks.  Each left row is sent to
the ``n_right`` tasks of its row-block and each right row to the ``n_left``
tasks of its column-block, so one task holds ``|L|/n_left + |R|/n_right``
rows — bounded memory however large the inputs are, and no hot key because
the block id is a hash of the row id.  The per-block function runs NumPy on
Arrow batches and emits only reduced output (top-k lists, class sums), never
the pair list itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096

#: Rows of a block whose task works through tiles of ``TILE`` by ``BLOCK_ROWS`` values, so that only rows take memory; rows that a smaller one should have.
SPAN, LEAST, TILE = 65536, 256, 512


def grid(n_left: int, n_right: int, cores: int) -> tuple[int, int]:
    """Blocks of both sides: as few as bounded rows allow, and enough pairs to use all cores twice."""
    side = math.ceil(math.sqrt(2 * cores))
    return tuple(max(1, math.ceil(n / SPAN), min(side, math.ceil(n / LEAST))) for n in (n_left, n_right))


def block_count(df: DataFrame, rows_per_block: int = BLOCK_ROWS, at_least: int = 1) -> int:
    """Blocks needed so that one block holds about ``rows_per_block`` rows."""
    n = df.count()
    return max(at_least, math.ceil(n / rows_per_block))


def hash_block(id_col: str, n: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(n)).cast("int")


def cogroup_blocks(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    n_left: int,
    n_right: int,
) -> DataFrame:
    """Run ``fn(left_block, right_block)`` for every pair of blocks."""
    lb = left.withColumn("_lb", hash_block(left_id, n_left)).withColumn(
        "_rb", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1)))
    )
    rb = right.withColumn("_rb", hash_block(right_id, n_right)).withColumn(
        "_lb", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1)))
    )

    def run(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        if len(lpdf) == 0 or len(rpdf) == 0:
            return pd.DataFrame({f.split()[0]: [] for f in schema.split(",")})
        return fn(lpdf.drop(columns=["_lb", "_rb"]), rpdf.drop(columns=["_lb", "_rb"]))

    return lb.groupBy("_lb", "_rb").cogroup(rb.groupBy("_lb", "_rb")).applyInPandas(run, schema)


def symmetric_blocks(df: DataFrame, id_col: str, fn: Callable[[pd.DataFrame, pd.DataFrame, bool], pd.DataFrame], schema: str,
                     n_blocks: int) -> DataFrame:
    """Run ``fn(block, other, same)`` for every unordered pair of blocks of one table.

    Each row goes to the ``n_blocks`` pairs of its block, half of what two sides need, and a function that uses a pair's matrix
    for both of its sides makes every value once.
    """
    b = df.withColumn("_b", hash_block(id_col, n_blocks)).withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    b = b.withColumn("_lo", F.least("_b", "_o")).withColumn("_hi", F.greatest("_b", "_o")).drop("_o")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf[pdf["_b"] == key[0]], pdf[pdf["_b"] == key[1]]
        if not len(lo) or not len(hi):
            return pd.DataFrame({f.split()[0]: [] for f in schema.split(",")})
        return fn(lo.drop(columns=["_b", "_lo", "_hi"]), hi.drop(columns=["_b", "_lo", "_hi"]), key[0] == key[1])

    return b.groupBy("_lo", "_hi").applyInPandas(run, schema)


def pair_blocks(df: DataFrame, rows_per_block: int = BLOCK_ROWS) -> int:
    """Blocks of a table for ``symmetric_blocks``: of bounded size, and enough pairs to use all cores."""
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(n / rows_per_block), min(math.ceil(math.sqrt(2 * cores)), math.ceil(n / 64)))


def matrix(col: pd.Series) -> np.ndarray:
    """Arrow list column → 2-D float64 matrix (rows of equal length)."""
    if len(col) == 0:
        return np.zeros((0, 0))
    return np.concatenate(col.to_numpy()).astype(np.float64, copy=False).reshape(len(col), -1)


def exact_sq_dists(q: np.ndarray, c: np.ndarray, step: int = 256) -> np.ndarray:
    """Squared distances added up position by position, in order.

    This is the arithmetic of a sequential sum over zipped arrays, bit for bit, so a bucket gives the
    same order of near ties whether it is compared here or as column expressions.
    """
    out = np.zeros((q.shape[0], c.shape[0]))
    for s in range(0, q.shape[0], step):
        part = out[s:s + step]
        for i in range(q.shape[1]):
            d = q[s:s + step, i, None] - c[None, :, i]
            d *= d
            part += d
    return out


def _slack(dim: int, most: float) -> float:
    """How far a squared distance from inner products may be off, for squared norms that add up to ``most``."""
    return 8 * (dim + 8) * float(np.finfo(np.float64).eps) * most


def sq_dists(a: np.ndarray, b: np.ndarray, atol: float) -> np.ndarray:
    """Squared distances from inner products, off by at most ``atol``; where that cannot be promised, added up one by one."""
    with np.errstate(over="ignore", invalid="ignore"):
        centre = a.mean(axis=0) if len(a) else 0.0
        a0, b0 = a - centre, b - centre
        an, bn = np.einsum("ij,ij->i", a0, a0), np.einsum("ij,ij->i", b0, b0)
        most = float(an.max(initial=0.0) + bn.max(initial=0.0))
        if not _slack(a.shape[1], most) <= atol:
            return exact_sq_dists(a, b)
    out = (-2.0 * a0) @ b0.T
    out += an[:, None]
    out += bn[None, :]
    return np.maximum(out, 0.0, out=out)


def tiles(n: int, m: int, rows: int | None = None, cols: int | None = None) -> Iterator[tuple[slice, slice]]:
    """An n × m product in parts that fit a core's memory."""
    rows, cols = rows or TILE, cols or BLOCK_ROWS
    for s in range(0, n, rows):
        for t in range(0, m, cols):
            yield slice(s, min(s + rows, n)), slice(t, min(t + cols, m))


def runs(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, start, count): an order that brings equal classes together, and where each then starts."""
    order = np.argsort(cls, kind="stable")
    _, start, count = np.unique(cls[order], return_index=True, return_counts=True)
    return order, start, count


def run_sums(part: np.ndarray, start: np.ndarray, span: slice, axis: int) -> tuple[np.ndarray, slice]:
    """(sums, which runs): the values of a part that spans ``span`` of an axis, added up over the runs that begin at ``start``."""
    first, end = np.searchsorted(start, [span.start, span.stop - 1], side="right")
    cut = np.maximum(start[first - 1:end], span.start) - span.start
    return np.add.reduceat(part, cut, axis=axis), slice(first - 1, end)


def _one_by_one(q: np.ndarray, c: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """The distances of ``exact_sq_dists`` of some pairs, bit for bit."""
    out = np.zeros(len(row))
    for i in range(q.shape[1]):
        d = q[row, i] - c[col, i]
        d *= d
        out += d
    return out


def _first_copies(c: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the candidates without those that ``k`` equal vectors of smaller ids always precede."""
    _, same = np.unique(np.ascontiguousarray(c).view(np.dtype((np.void, c.dtype.itemsize * c.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, same))
    same, ids = same[order], ids[order]
    new_vec = np.r_[True, same[1:] != same[:-1]]
    new_id = new_vec | np.r_[True, ids[1:] != ids[:-1]]
    at = np.arange(len(order))
    nth_id = np.cumsum(new_id)
    nth_id -= np.maximum.accumulate(np.where(new_vec, nth_id, 0))
    return order[(nth_id <= k) & (at - np.maximum.accumulate(np.where(new_id, at, 0)) < k)]


def k_nearest(q: np.ndarray, c: np.ndarray, q_ids: np.ndarray, c_ids: np.ndarray, k: int, exclude_self: bool = False,
              cell_rows: int = BLOCK_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, squared distance) of the ``k`` nearest candidates of each row, ties by id; infinite ones never.

    Candidates lie in cells around pivots.  Rows meet cells from near to far and skip one whose covering radius does not
    reach within their k-th distance so far.  Inner products bound the distances; pairs within the bound and its rounding
    are added up one by one, so the result is that of ``exact_sq_dists`` and ``nearest`` over the whole product.
    """
    at_q, at_c = (np.flatnonzero(np.isfinite(x).all(axis=1)) for x in (q, c))
    if not len(at_q) or not len(at_c) or not q.shape[1]:
        at_c = at_c[:0]
    else:
        at_c = at_c[_first_copies(c[at_c], c_ids[at_c], k)]
    found = [(np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0))]
    if len(at_c):
        q, c, q_ids, c_ids = q[at_q], c[at_c], q_ids[at_q], c_ids[at_c]
        with np.errstate(over="ignore", invalid="ignore"):
            qn, cn = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", c, c)
            wide = not np.isfinite(4 * (qn.max() + cn.max()))
        search = _by_exact if wide else _by_cells(c, cn, cell_rows)
        for s in range(0, len(q), TILE):
            row, col, d2 = search(q[s:s + TILE], qn[s:s + TILE], q_ids[s:s + TILE], c, c_ids, k, exclude_self)
            found.append((at_q[row + s], at_c[col], d2))
    return tuple(np.concatenate(x) for x in zip(*found))


def _by_exact(q, qn, q_ids, c, c_ids, k, exclude_self):
    d2 = exact_sq_dists(q, c)
    if exclude_self:
        d2[q_ids[:, None] == c_ids[None, :]] = np.inf
    row, col = nearest(d2, c_ids, k)
    return row, col, d2[row, col]


def _by_cells(c: np.ndarray, cn: np.ndarray, cell_rows: int) -> Callable:
    pivots = c[:math.ceil(len(c) / cell_rows)]
    pn = cn[:len(pivots)]
    own, far = np.zeros(len(c), dtype=int), np.zeros(len(c))
    for s in range(0, len(c), TILE):
        d = cn[s:s + TILE, None] + pn - 2.0 * (c[s:s + TILE] @ pivots.T)
        own[s:s + TILE] = d.argmin(axis=1)
        far[s:s + TILE] = d.min(axis=1)
    order = np.argsort(own, kind="stable")
    start = np.searchsorted(own[order], np.arange(len(pivots) + 1))
    held = [i for i in range(len(pivots)) if start[i] < start[i + 1]]
    slack_c = _slack(c.shape[1], float(2 * cn.max()))
    radius = {i: math.sqrt(max(0.0, far[order[start[i]:start[i + 1]]].max()) + slack_c) for i in held}
    # a column of squared norms makes the product |c|² − 2 q·c
    wide = np.column_stack([c[order], cn[order]])

    def search(q, qn, q_ids, c, c_ids, k, exclude_self):
        slack = _slack(q.shape[1], 1.0) * (qn + cn.max())
        to_pivots = qn[:, None] + pn - 2.0 * (q @ pivots.T)
        least = np.sqrt(np.maximum(to_pivots - slack[:, None], 0.0))
        turned = np.column_stack([-2.0 * q, np.ones(len(q))])
        reach = np.full(len(q), np.inf)
        kept = [(np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0))]
        rows, cols, waiting = [], [], 0

        def settle():
            nonlocal kept, rows, cols, waiting
            row, col = np.concatenate([kept[0][0], *rows]), np.concatenate([kept[0][1], *cols])
            d2 = np.concatenate([kept[0][2], _one_by_one(q, c, row[len(kept[0][0]):], col[len(kept[0][0]):])])
            by = np.lexsort((c_ids[col], d2, row))
            by = by[np.isfinite(d2[by])]
            place = np.arange(len(by)) - np.searchsorted(row[by], row[by])
            by = by[place < k]
            last = np.flatnonzero(place[place < k] == k - 1)
            row, col, d2 = row[by], col[by], d2[by]
            reach[row[last]] = d2[last]
            kept, rows, cols, waiting = [(row, col, d2)], [], [], 0

        for cell in sorted(held, key=lambda i: to_pivots[:, i].mean()):
            for s in range(start[cell], start[cell + 1], BLOCK_ROWS):
                alive = np.flatnonzero(least[:, cell] - radius[cell] <= np.sqrt(reach + slack))
                if not len(alive):
                    break
                here = order[s:min(s + BLOCK_ROWS, start[cell + 1])]
                g = turned[alive] @ wide[s:s + len(here)].T if len(alive) < len(q) else turned @ wide[s:s + len(here)].T
                bound = reach[alive] - qn[alive]
                if not np.isfinite(bound).all():
                    if exclude_self:
                        g[q_ids[alive, None] == c_ids[None, here]] = np.inf
                    if k < len(here):
                        bound = np.minimum(bound, np.partition(g, k - 1, axis=1)[:, k - 1])
                hit = np.flatnonzero(g <= (bound + 2 * slack[alive])[:, None])
                row, col = alive[hit // len(here)], here[hit % len(here)]
                if exclude_self:
                    other = q_ids[row] != c_ids[col]
                    row, col = row[other], col[other]
                rows.append(row)
                cols.append(col)
                waiting += len(row)
                if waiting > k * len(q):
                    settle()
        settle()
        return kept[0]

    return search


def nearest(d2: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` nearest candidates of each row, nearest first, ties by id; infinite ones never."""
    n, m = d2.shape
    if not n or not m:
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    cut = np.partition(d2, k - 1, axis=1)[:, k - 1] if k < m else d2.max(axis=1, initial=-np.inf)
    row, col = np.nonzero((d2 <= cut[:, None]) & np.isfinite(d2))
    order = np.lexsort((ids[col], d2[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k]


def group_sizes(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key on both sides → (keys..., n_left, n_right)."""
    nl = left.groupBy(*[F.col(k).alias(k) for k in keys]).agg(F.count("*").alias("n_left"))
    nr = right.groupBy(*[F.col(k).alias(k) for k in keys]).agg(F.count("*").alias("n_right"))
    return nl.join(nr, keys)


def split_hot(left: DataFrame, right: DataFrame, keys: list[str], pair_limit: int = BLOCK_ROWS * 64):
    """Split both sides into (cold, hot) by the number of pairs their key would form.

    Cold keys go through an ordinary equi-join; hot keys (one key may hold a
    third of the data) go through ``cogroup_grouped_blocks`` so no task holds
    more than a block per side.
    """
    sizes = group_sizes(left, right, keys)
    hot = sizes.where(F.col("n_left") * F.col("n_right") > pair_limit)
    hot_keys = hot.select(*[F.col(k).alias(k) for k in keys], "n_left", "n_right")
    return (
        left.join(hot_keys.select(*keys), keys, "left_anti"),
        right.join(hot_keys.select(*keys), keys, "left_anti"),
        hot_keys,
    )


def cogroup_grouped_blocks(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    sizes: DataFrame,
    left_id: str,
    right_id: str,
    fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    rows_per_block: int = BLOCK_ROWS,
) -> DataFrame:
    """Like ``cogroup_blocks`` but within each key: a key with many rows is cut into
    ceil(rows / rows_per_block) sub-blocks per side, each pair of sub-blocks is one task."""
    s = sizes.select(
        *keys,
        F.greatest(F.lit(1), F.ceil(F.col("n_left") / rows_per_block)).cast("int").alias("_sl"),
        F.greatest(F.lit(1), F.ceil(F.col("n_right") / rows_per_block)).cast("int").alias("_sr"),
    )
    lb = left.join(s, keys).withColumn("_lb", F.pmod(F.xxhash64(F.col(left_id)), F.col("_sl")).cast("int")).withColumn(
        "_rb", F.explode(F.sequence(F.lit(0), F.col("_sr") - 1))).drop("_sl", "_sr")
    rb = right.join(s, keys).withColumn("_rb", F.pmod(F.xxhash64(F.col(right_id)), F.col("_sr")).cast("int")).withColumn(
        "_lb", F.explode(F.sequence(F.lit(0), F.col("_sl") - 1))).drop("_sl", "_sr")

    def run(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        if len(lpdf) == 0 or len(rpdf) == 0:
            return pd.DataFrame({f.split()[0]: [] for f in schema.split(",")})
        return fn(lpdf.drop(columns=["_lb", "_rb"]), rpdf.drop(columns=["_lb", "_rb"]))

    g = list(keys) + ["_lb", "_rb"]
    return lb.groupBy(*g).cogroup(rb.groupBy(*g)).applyInPandas(run, schema)
