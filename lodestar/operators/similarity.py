"""Nearest-neighbour search, pair kernels and neighbour voting."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators import blocks, powersums
from lodestar.session import cut_lineage


def top_k_per_query(pairs: DataFrame, k: int, query: str = "query_id", dist: str = "distance",
                    tie: str = "neighbour_id", rank: str = "rank") -> DataFrame:
    """K nearest per query, ties by id.  Plans as WindowGroupLimit (partial + final)."""
    w = Window.partitionBy(query).orderBy(F.col(dist).asc(), F.col(tie).asc())
    return pairs.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def dedupe_first_by_group(pairs: DataFrame, group: str, query: str = "query_id",
                          dist: str = "distance", tie: str = "neighbour_id") -> DataFrame:
    """Keep the nearest neighbour of each (query, group), e.g. one box per image."""
    w = Window.partitionBy(query, group).orderBy(F.col(dist).asc(), F.col(tie).asc())
    return pairs.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def rank_within_class(df: DataFrame, cls: str, dist: str, tie: str) -> DataFrame:
    """Rank of each row by distance to its class centroid (ties share a rank).

    The rank is one more than the rows of the class that are nearer: rows are counted by distance, the
    counts are added up range by range, and each row looks its distance up, so no class is one task.
    """
    from lodestar.operators.prefix import running_totals

    counts = df.groupBy(cls, dist).agg(F.count(F.lit(1)).alias("_n"))
    nearer = running_totals(counts, [(dist, True)], {"_before": F.col("_n")}, partition_by=[cls], exclusive=True)
    nearer = nearer.select(F.col(cls).alias("_c"), F.col(dist).alias("_d"), (F.col("_before") + 1).cast("int").alias("rank"))
    same = F.col(cls).eqNullSafe(F.col("_c")) & F.col(dist).eqNullSafe(F.col("_d"))
    return df.join(nearer, same).drop("_c", "_d")


def _topk_block(k: int, exclude_self: bool, qid: str, cid: str, qv: str, cv: str, extra: Sequence[str], cell_rows: int):
    def fn(qp: pd.DataFrame, cp: pd.DataFrame) -> pd.DataFrame:
        qids, cids = qp[qid].to_numpy(), cp[cid].to_numpy()
        row, col, d2 = blocks.k_nearest(blocks.matrix(qp[qv]), blocks.matrix(cp[cv]), qids, cids, k, exclude_self, cell_rows)
        data = {"query_id": qids[row], "neighbour_id": cids[col], "distance": np.sqrt(d2)}
        return pd.DataFrame(data | {e: cp[e].to_numpy()[col] for e in extra})

    return fn


#: Candidates that a cell of the kNN join is meant to hold.
CELL_ROWS = 4096


def knn_join(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    qid: str = "vec_id",
    cid: str = "vec_id",
    vec: str = "v",
    exclude_self: bool = False,
    carry: Sequence[tuple[str, str]] = (),
    cell_rows: int | None = None,
) -> DataFrame:
    """Exact k nearest candidates of every query → (query_id, neighbour_id, distance, rank, carry...).

    Queries and candidates meet in pairs of blocks of up to ``blocks.SPAN`` rows.  A task puts its candidates in the cells of
    their nearest pivots and lets a query skip cells that cannot hold one within its k-th distance so far; it gives back k rows a
    query.  These lists are merged by a ``row_number() <= k`` window.  ``carry`` names candidate columns (name, Spark type) to return
    with each neighbour.
    """
    extra = [c for c, _ in carry]
    q = queries.select(F.col(qid).alias("_qid"), F.col(vec).cast("array<double>").alias("_qv"))
    c = candidates.select(F.col(cid).alias("_cid"), F.col(vec).cast("array<double>").alias("_cv"), *extra)
    schema = "query_id long, neighbour_id long, distance double" + "".join(f", {n} {t}" for n, t in carry)
    n_q, n_c = blocks.grid(q.count(), c.count(), queries.sparkSession.sparkContext.defaultParallelism)
    fn = _topk_block(k, exclude_self, "_qid", "_cid", "_qv", "_cv", extra, cell_rows or CELL_ROWS)
    return top_k_per_query(blocks.cogroup_blocks(q, c, "_qid", "_cid", fn, schema, n_q, n_c), k)


def knn_join_expr(queries: DataFrame, candidates: DataFrame, k: int, qid: str = "vec_id",
                  cid: str = "vec_id", vec: str = "v", exclude_self: bool = False) -> DataFrame:
    """J7 as pure column expressions over a theta join.

    Quadratic in rows: only for tiny inputs and as a test reference for ``knn_join``;
    no registered query uses it."""
    from lodestar.functions.vectors import l2_distance

    q = queries.select(F.col(qid).alias("query_id"), F.col(vec).cast("array<double>").alias("_qv"))
    c = candidates.select(F.col(cid).alias("neighbour_id"), F.col(vec).cast("array<double>").alias("_cv"))
    cond = F.col("query_id") != F.col("neighbour_id") if exclude_self else F.lit(True)
    pairs = q.join(c, cond).select("query_id", "neighbour_id", l2_distance("_qv", "_cv").alias("distance"))
    return top_k_per_query(pairs, k)


def vote_share(neighbours: DataFrame, label: str = "label", query: str = "query_id") -> DataFrame:
    """Share of each class among a query's kept neighbours."""
    w = Window.partitionBy(query)
    counts = neighbours.groupBy(query, label).agg(F.count("*").alias("votes"))
    return counts.withColumn("share", F.col("votes") / F.sum("votes").over(w))


def knn_classify(train: DataFrame, test: DataFrame, k: int, exclude_self: bool = False,
                 vec: str = "v", label: str = "label", id_col: str = "vec_id") -> DataFrame:
    """M11 (single k): majority class of the k nearest; ties by more votes, nearer, smaller label."""
    nb = knn_join(test, train, k, qid=id_col, cid=id_col, vec=vec, exclude_self=exclude_self,
                  carry=[(label, "int")])
    agg = nb.groupBy("query_id", label).agg(F.count("*").alias("votes"), F.min("distance").alias("nearest"))
    w = Window.partitionBy("query_id").orderBy(F.col("votes").desc(), F.col("nearest").asc(), F.col(label).asc())
    return agg.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        "query_id", F.col(label).alias("predicted"), "votes")


def knn_classify_many_k(train: DataFrame, test: DataFrame, ks: Sequence[int], vec: str = "v",
                        label: str = "label", id_col: str = "vec_id", exclude_self: bool = True,
                        priors: DataFrame | None = None) -> DataFrame:
    """Predictions for every k in ``ks`` from one neighbour pass at max(ks).

    Votes accumulate along the neighbour rank; optional ``priors(label, weight)``
    multiplies each class's votes (prior over class size, for example).
    """
    kmax = max(ks)
    nb = knn_join(test, train, kmax, qid=id_col, cid=id_col, vec=vec, exclude_self=exclude_self,
                  carry=[(label, "int")])
    # each neighbour counts for every k at or above its rank (a generator, not a join)
    karr = F.array(*[F.lit(int(k)) for k in sorted(ks)])
    per = nb.withColumn("k", F.explode(F.filter(karr, lambda k: k >= F.col("rank"))))
    agg = per.groupBy("k", "query_id", label).agg(F.count("*").alias("votes"), F.min("distance").alias("nearest"))
    score = F.col("votes").cast("double")
    if priors is not None:
        agg = agg.join(priors, label, "left")
        score = score * F.coalesce(F.col("weight"), F.lit(1.0))
    agg = agg.withColumn("score", score)
    w = Window.partitionBy("k", "query_id").orderBy(F.col("score").desc(), F.col("nearest").asc(), F.col(label).asc())
    return agg.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        "k", "query_id", F.col(label).alias("predicted"))


def knn_regress(train: DataFrame, test: DataFrame, k: int, target: str, vec: str = "v",
                id_col: str = "vec_id", exclude_self: bool = False) -> DataFrame:
    """Mean target of the k nearest."""
    nb = knn_join(test, train, k, qid=id_col, cid=id_col, vec=vec, exclude_self=exclude_self,
                  carry=[(target, "double")])
    return nb.groupBy("query_id").agg(F.avg(target).alias("prediction"))


# ---------------------------------------------------------------- pair kernels

def _kernel_np(kind: str | Callable, param: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A named kernel, or (X3) any function of two blocks and the parameter that gives their matrix."""
    if callable(kind):
        return lambda a, b: kind(a, b, param)
    if kind == "rbf":
        return lambda a, b: np.exp(-blocks.sq_dists(a, b, 1e-11 * param * param) / (param * param))
    if kind == "linear":
        return lambda a, b: a @ b.T
    if kind == "vovk":
        p = int(param)

        def vk(a, b):
            d = a @ b.T
            with np.errstate(divide="ignore", invalid="ignore"):
                out = (1.0 - d ** p) / (1.0 - d)
            return np.where(d == 1.0, float(p), out)

        return vk
    raise ValueError(kind)


def kernel_block_sum(left: DataFrame, right: DataFrame, kind: str | Callable, param: float, lcls: str = "label",
                     rcls: str = "label", lid: str = "vec_id", rid: str = "vec_id", vec: str = "v",
                     n_left: int | None = None, n_right: int | None = None) -> DataFrame:
    """Σ k(x, y) and pair counts for every (class of x, class of y).

    Kernels that are sums of powers of the inner product (linear, vovk) take one scan.  Others are summed over pairs of
    blocks; the Gaussian one over a table with itself makes each value once.
    """
    found = powersums.fits(left, lcls, vec, kind, param)
    other = found if right is left and lcls == rcls else found and powersums.fits(right, rcls, vec, kind, param)
    if found and other:
        return powersums.class_sums(left, right, (found, other), kind, param, lcls, rcls, vec)
    kern = _kernel_np(kind, param)

    def sums(x: np.ndarray, y: np.ndarray, lc: np.ndarray, rc: np.ndarray, both: bool) -> pd.DataFrame:
        (by_l, ls, ln), (by_r, rs, rn) = blocks.runs(lc), blocks.runs(rc)
        x, y = x[by_l], y[by_r]
        total = np.zeros((len(ls), len(rs)))
        for rows, cols in blocks.tiles(len(x), len(y)):
            part, at = blocks.run_sums(kern(x[rows], y[cols]), rs, cols, axis=1)
            part, up = blocks.run_sums(part, ls, rows, axis=0)
            total[up, at] += part
        made = pd.DataFrame({"class_i": np.repeat(lc[by_l][ls], len(rs)), "class_j": np.tile(rc[by_r][rs], len(ls)), "ksum": total.ravel(),
                             "pairs": np.outer(ln, rn).ravel()})
        return pd.concat([made, made.rename(columns={"class_i": "class_j", "class_j": "class_i"})]) if both else made

    def fn(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        return sums(blocks.matrix(lp["_lv"]), blocks.matrix(rp["_rv"]), lp["_lc"].to_numpy(), rp["_rc"].to_numpy(), False)

    def own(lp: pd.DataFrame, rp: pd.DataFrame, same: bool) -> pd.DataFrame:
        return sums(blocks.matrix(lp["_lv"]), blocks.matrix(rp["_lv"]), lp["_lc"].to_numpy(), rp["_lc"].to_numpy(), not same)

    schema = "class_i int, class_j int, ksum double, pairs long"
    lsel = left.select(F.col(lid).alias("_lid"), F.col(vec).cast("array<double>").alias("_lv"), F.col(lcls).alias("_lc"))
    if right is left and lcls == rcls and lid == rid and not callable(kind):
        part = blocks.symmetric_blocks(lsel, "_lid", own, schema, n_left or blocks.pair_blocks(left, blocks.SPAN))
    else:
        rsel = right.select(F.col(rid).alias("_rid"), F.col(vec).cast("array<double>").alias("_rv"), F.col(rcls).alias("_rc"))
        nl, nr = n_left, n_right
        if not (nl and nr):
            made = blocks.grid(left.count(), right.count(), left.sparkSession.sparkContext.defaultParallelism)
            nl, nr = nl or made[0], nr or made[1]
        part = blocks.cogroup_blocks(lsel, rsel, "_lid", "_rid", fn, schema, nl, nr)
    return part.groupBy("class_i", "class_j").agg(F.sum("ksum").alias("ksum"), F.sum("pairs").alias("pairs"))


def kernel_row_sums(test: DataFrame, train: DataFrame, kind: str | Callable, param: float, cls: str = "label",
                    tid: str = "vec_id", rid: str = "vec_id", vec: str = "v") -> DataFrame:
    """Σ_{y in class c} k(x, y) for every test row x; sums of powers in one scan, others over pairs of blocks."""
    found = powersums.fits(train, cls, vec, kind, param)
    if found:
        return powersums.row_sums(test, train, found, kind, param, cls, tid, vec)
    kern = _kernel_np(kind, param)

    def frame(ids: np.ndarray, labels: np.ndarray, found: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"test_id": np.repeat(ids, len(labels)), "label": np.tile(labels, len(ids)), "ksum": found.ravel()})

    def sums(x: np.ndarray, y: np.ndarray, lc: np.ndarray | None, rc: np.ndarray, lids: np.ndarray, rids: np.ndarray | None) -> pd.DataFrame:
        """Sums of the rows of ``x`` over the classes of ``y`` and, with ``lc``, the other way round."""
        by_r, rs, _ = blocks.runs(rc)
        by_l, ls, _ = blocks.runs(np.zeros(len(x)) if lc is None else lc)
        x, y = x[by_l], y[by_r]
        of_x, of_y = np.zeros((len(x), len(rs))), np.zeros((len(ls), len(y)))
        for rows, cols in blocks.tiles(len(x), len(y)):
            k = kern(x[rows], y[cols])
            part, at = blocks.run_sums(k, rs, cols, axis=1)
            of_x[rows, at] += part
            if lc is not None:
                part, up = blocks.run_sums(k, ls, rows, axis=0)
                of_y[up, cols] += part
        made = frame(lids[by_l], rc[by_r][rs], of_x)
        return made if lc is None else pd.concat([made, frame(rids[by_r], lc[by_l][ls], of_y.T)], ignore_index=True)

    def fn(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        return sums(blocks.matrix(lp["_lv"]), blocks.matrix(rp["_rv"]), None, rp["_rc"].to_numpy(), lp["_lid"].to_numpy(), None)

    def own(lp: pd.DataFrame, rp: pd.DataFrame, same: bool) -> pd.DataFrame:
        lc = None if same else lp["_lc"].to_numpy()
        return sums(blocks.matrix(lp["_lv"]), blocks.matrix(rp["_lv"]), lc, rp["_lc"].to_numpy(), lp["_lid"].to_numpy(), rp["_lid"].to_numpy())

    schema = "test_id long, label int, ksum double"
    lsel = test.select(F.col(tid).alias("_lid"), F.col(vec).cast("array<double>").alias("_lv"))
    if test is train and tid == rid and not callable(kind):
        part = blocks.symmetric_blocks(train.select(F.col(tid).alias("_lid"), F.col(vec).cast("array<double>").alias("_lv"), F.col(cls).alias("_lc")),
                                       "_lid", own, schema, blocks.pair_blocks(train, blocks.SPAN))
    else:
        rsel = train.select(F.col(rid).alias("_rid"), F.col(vec).cast("array<double>").alias("_rv"), F.col(cls).alias("_rc"))
        nl, nr = blocks.grid(test.count(), train.count(), test.sparkSession.sparkContext.defaultParallelism)
        part = blocks.cogroup_blocks(lsel, rsel, "_lid", "_rid", fn, schema, nl, nr)
    return part.groupBy("test_id", "label").agg(F.sum("ksum").alias("ksum"))


def kernel_nearest_mean(train: DataFrame, test: DataFrame, kind: str, param: float,
                        cls: str = "label", vec: str = "v", id_col: str = "vec_id") -> DataFrame:
    """Class whose kernel mean embedding is nearest: k(x,x) − 2/n Σk(x,y) + 1/n² ΣΣk(y,y').

    Kernels other than sums of powers must have k(x, x) = 1.
    """
    sizes = train.groupBy(F.col(cls).alias("label")).agg(F.count("*").alias("n"))
    rows = cut_lineage(kernel_row_sums(test, train, kind, param, cls, id_col, id_col, vec))
    # the sums within a class are the training rows' own sums with it; one pass serves both when they are the test
    own = rows if test is train else kernel_row_sums(train, train, kind, param, cls, id_col, id_col, vec)
    mine = train.select(F.col(id_col).alias("test_id"), F.col(cls).alias("label"))
    within = own.join(mine, ["test_id", "label"]).groupBy("label").agg(F.sum("ksum").alias("ksum"))
    from lodestar.functions.vectors import dot

    xx = dot(F.col(vec), F.col(vec))
    powers = None if callable(kind) else powersums.degrees(kind, param)
    self_k = F.lit(1.0) if powers is None else sum((F.pow(xx, F.lit(float(j))) for j in powers), F.lit(0.0))
    tself = test.select(F.col(id_col).alias("test_id"), self_k.alias("kxx"))
    # one row per class; AQE broadcasts it from its measured size
    st = within.join(sizes, "label").withColumnRenamed("ksum", "ksum_w")
    d = rows.join(st, "label").join(tself, "test_id").withColumn(
        "dist2", F.col("kxx") - 2.0 * F.col("ksum") / F.col("n") + F.col("ksum_w") / (F.col("n") * F.col("n"))
    )
    w = Window.partitionBy("test_id").orderBy(F.col("dist2").asc(), F.col("label").asc())
    return d.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        "test_id", F.col("label").alias("predicted"), "dist2")
