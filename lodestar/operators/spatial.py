"""Points and sites in the plane over places of any density.

Points lie in square cells whose side is the radius; a cell with too many points is cut into quarters, again and
again, until each leaf holds a bounded number.  Sites come down this tree: a node that lies wholly inside a site's
circle is settled there, one outside is dropped, and only leaves that the circle's edge crosses are compared point by
point.  A leaf near many sites is compared in blocks of sites, so no task holds more than a leaf and a block,
wherever the points are.

Counts, coverings and covers look at equal places once and meet a leaf's points and a block's sites inside a task, tile
by tile, so that what moves is points, sites and one number for each, never their pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import cut_lineage

#: Points of a leaf, sites of a block, and the depth at which cutting stops (points that are all but equal).
LEAF, BLOCK, DEEPEST = 4096, 4096, 24
#: Both, where pairs are met inside a task and only places take memory.
SPAN = 65536
#: Places of a tile, and places that look for others at a time.
TILE, STEP = 64, 1024
#: Up to so many nodes are told to every task; beyond, joins shuffle.
TOLD = 10_000

KEY = ["cx", "cy", "lv", "ix", "iy"]


def _place(points: DataFrame, r: float) -> DataFrame:
    """Adds the place in units of the radius: cell (cx, cy) and the share of the way through it."""
    u, v = F.col("x") / r, F.col("y") / r
    return points.withColumn("cx", F.floor(u).cast("long")).withColumn("cy", F.floor(v).cast("long")).withColumn(
        "fx", u - F.col("cx")).withColumn("fy", v - F.col("cy"))


class Quadtree:
    """``points`` (with their leaf) and ``nodes`` (key, n, leaf); equal places beyond the deepest level stay in one leaf."""

    def __init__(self, points: DataFrame, r: float, leaf: int = LEAF):
        self.r, self.leaf = r, leaf
        zero = F.lit(0)
        points = points.where(F.abs("x") + F.abs("y") < F.lit(float("inf")))  # others are in range of nothing
        left = _place(points, r).select("*", zero.cast("int").alias("lv"), zero.cast("long").alias("ix"), zero.cast("long").alias("iy"))
        self.points, self.nodes, self.levels, self.crowded = None, None, 0, False
        while True:
            spread = (F.min("fx") < F.max("fx")) | (F.min("fy") < F.max("fy"))  # one place cannot be cut
            counts = left.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), spread.alias("_s"))
            nodes = cut_lineage(counts.withColumn("leaf", ~(F.col("_s") & (F.col("n") > leaf) & (F.col("lv") < DEEPEST))).drop("_s"))
            self.nodes = nodes if self.nodes is None else self.nodes.unionByName(nodes)
            dense = nodes.where("NOT leaf").select(*KEY)
            n_dense, n_crowded = nodes.agg(F.count(F.when(~F.col("leaf"), 1)), F.count(F.when(F.col("leaf") & (F.col("n") > leaf), 1))).first()
            self.crowded |= n_crowded > 0
            if not n_dense:
                self.points = left if self.points is None else self.points.unionByName(left)
                return
            told = F.broadcast(dense) if n_dense <= TOLD else dense
            done = left.join(told, KEY, "left_anti").select(*left.columns)
            self.points = done if self.points is None else self.points.unionByName(done)
            self.levels += 1
            scale = F.lit(float(1 << self.levels))
            left = cut_lineage(left.join(told, KEY, "left_semi").select(
                *[c for c in left.columns if c not in ("lv", "ix", "iy")], F.lit(self.levels).cast("int").alias("lv"),
                F.floor(F.col("fx") * scale).cast("long").alias("ix"), F.floor(F.col("fy") * scale).cast("long").alias("iy")))

    def ancestors(self, nodes: DataFrame) -> DataFrame:
        """Every node once for itself and once for each node above it, whose key is in ``up``."""
        up = F.transform(F.sequence(F.lit(0), F.col("lv")), lambda lv: F.struct(
            F.col("cx"), F.col("cy"), lv.cast("int").alias("lv"), F.floor(F.col("ix") / F.pow(F.lit(2.0), F.col("lv") - lv)).cast("long").alias("ix"),
            F.floor(F.col("iy") / F.pow(F.lit(2.0), F.col("lv") - lv)).cast("long").alias("iy")))
        return nodes.withColumn("up", F.explode(up))

    def relate(self, sites: DataFrame, settle: bool = True) -> tuple[DataFrame | None, DataFrame]:
        """(whole, edge): for sites (site_id, x, y), the nodes wholly in range and the leaves to be compared, each with the node's key.

        Without ``settle`` a node in range is followed down to its leaves, and ``whole`` is None.
        """
        s = _place(sites, self.r).select("site_id", F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("cx").alias("scx"), F.col("cy").alias("scy"),
                                         F.col("fx").alias("sfx"), F.col("fy").alias("sfy"))
        near = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
        zero = F.lit(0)
        front = s.withColumn("o", F.explode(near)).select(
            *s.columns, (F.col("scx") + F.col("o.dx")).alias("cx"), (F.col("scy") + F.col("o.dy")).alias("cy"), zero.cast("int").alias("lv"),
            zero.cast("long").alias("ix"), zero.cast("long").alias("iy"))
        whole, edge = None, None
        for lv in range(self.levels + 1):
            met = front.join(self.nodes.where(F.col("lv") == lv), KEY)
            side = 2.0 ** -lv

            def span(cell: str, index: str, site_cell: str, site_share: str) -> tuple[Column, Column]:
                """(least, largest) distance along one axis, in radii; differences of cells are exact."""
                low = (F.col(cell) - F.col(site_cell)) + F.col(index) * side - F.col(site_share)
                return F.greatest(low, -(low + side), F.lit(0.0)), F.greatest(F.abs(low), F.abs(low + side))

            (ax, bx), (ay, by) = span("cx", "ix", "scx", "sfx"), span("cy", "iy", "scy", "sfy")
            # a place in radii is rounded like a number of the size of its cell
            slack = F.lit(1e-12) + F.lit(1e-15) * (F.abs("cx") + F.abs("cy"))
            met = met.where(ax * ax + ay * ay <= 1 + 4 * slack).withColumn("inside", (bx * bx + by * by <= 1 - 4 * slack) & F.lit(settle))
            if lv < self.levels:
                met = cut_lineage(met)
            own_edge = met.where("leaf AND NOT inside").select("site_id", "sx", "sy", *KEY)
            edge = own_edge if edge is None else edge.unionByName(own_edge)
            if settle:
                own = met.where("inside").select("site_id", *KEY)
                whole = own if whole is None else whole.unionByName(own)
            if lv < self.levels:
                quarter = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (0, 1) for j in (0, 1)])
                front = met.where("NOT leaf AND NOT inside").withColumn("q", F.explode(quarter)).select(
                    *s.columns, "cx", "cy", F.lit(lv + 1).cast("int").alias("lv"), (F.col("ix") * 2 + F.col("q.dx")).alias("ix"),
                    (F.col("iy") * 2 + F.col("q.dy")).alias("iy"))
        return whole, edge


def blocks_of(df: DataFrame, count: int) -> DataFrame | None:
    """Keys with more than ``count`` rows and the number ``_k`` of blocks of that size; None if there are none."""
    many = df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > count).select(*KEY, F.ceil(F.col("_c") / count).cast("int").alias("_k"))
    many = cut_lineage(many)
    n = many.count()
    return None if not n else F.broadcast(many) if n <= TOLD else many


def _dealt(few: DataFrame, many: DataFrame, blocks: DataFrame | None, key: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``many`` in blocks by a hash of ``key``, and rows of ``few`` once for each block of their leaf."""
    if blocks is None:
        return few, many
    one = F.coalesce("_k", F.lit(1))
    return (few.join(blocks, KEY, "left").withColumn(name, F.explode(F.sequence(F.lit(0), one - 1))).drop("_k"),
            many.join(blocks, KEY, "left").withColumn(name, F.pmod(F.xxhash64(key), one).cast("int")).drop("_k"))


def _tiles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(tile, place in it): rows of near places, in strips along y that are cut along x; the last tile is filled up with its last row."""
    n = -(-len(x) // TILE)
    strip = TILE * max(1, round(n ** 0.5))
    by_y = np.argsort(y, kind="stable")
    order = by_y[np.lexsort((x[by_y], np.arange(len(x)) // strip))]
    return np.r_[order, np.repeat(order[-1:], n * TILE - len(x))].reshape(n, TILE)


def _seen(qx: np.ndarray, qy: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray, r: float, value: np.ndarray | None = None,
          nearest: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each place (qx, qy): the sum of ``w``, the least ``value`` and the least distance of the places (x, y) within ``r``.

    A tile whose far corner is in range counts whole, one whose near side is not is left out; others are compared place by place.
    Rounding keeps the order of distances, so a corner's bounds those of the whole tile to the last bit.
    """
    rows = _tiles(x, y)
    real = (np.arange(rows.size) < len(x)).reshape(rows.shape)
    tx, ty, tw = x[rows], y[rows], np.where(real, w[rows], 0)
    box = tx.min(1), tx.max(1), ty.min(1), ty.max(1)
    whole = tw.sum(1)
    values = None if value is None else value[rows]
    n, least, near = np.zeros(len(qx), dtype=np.int64), np.full(len(qx), np.inf), np.full(len(qx), np.inf)

    def compared(at: np.ndarray, tile: np.ndarray):
        """(stretch of the pairs, distances) of places and tiles."""
        for a in range(0, len(at), STEP * 8):
            part = slice(a, a + STEP * 8)
            dx, dy = tx[tile[part]] - qx[at[part], None], ty[tile[part]] - qy[at[part], None]
            yield part, np.sqrt(dx * dx + dy * dy)

    for start in range(0, len(qx), STEP):
        sx, sy = qx[start:start + STEP, None], qy[start:start + STEP, None]
        (ax, bx), (ay, by) = ((lo - s, hi - s) for lo, hi, s in ((box[0], box[1], sx), (box[2], box[3], sy)))
        fx, fy = np.maximum(np.abs(ax), np.abs(bx)), np.maximum(np.abs(ay), np.abs(by))
        cx, cy = np.maximum(np.maximum(ax, -bx), 0), np.maximum(np.maximum(ay, -by), 0)
        far, close = np.sqrt(fx * fx + fy * fy), np.sqrt(cx * cx + cy * cy)
        inside = far <= r
        end = start + len(sx)
        n[start:end] += inside @ whole
        if values is not None:
            least[start:end] = np.where(inside, values.min(1), np.inf).min(1)
        at, tile = np.nonzero(~inside & (close <= r))
        at += start
        for part, d in compared(at, tile):
            met = d <= r
            np.add.at(n, at[part], (met * tw[tile[part]]).sum(1))
            if values is not None:
                np.minimum.at(least, at[part], np.where(met, values[tile[part]], np.inf).min(1))
        if nearest:
            at, tile = np.nonzero(close <= np.minimum(far.min(1), r)[:, None])
            at += start
            for part, d in compared(at, tile):
                np.minimum.at(near, at[part], d.min(1))
    return n, least, np.where(near <= r, near, np.inf)


class Edges:
    """Points of leaves and the sites to compare them with.

    A leaf near many sites is dealt out in blocks of them, and one of many points at one place in blocks of points, so
    the pairs of one key are bounded.  The blocks are laid out once, for all sites; later rounds have fewer.
    """

    def __init__(self, tree: Quadtree, edge: DataFrame, block: int = BLOCK):
        self.tree, self.edge = tree, edge
        self.site_blocks = blocks_of(edge, block)
        self.point_blocks = blocks_of(tree.points, tree.leaf) if tree.crowded else None

    def near(self, points: DataFrame, edge: DataFrame | None = None) -> DataFrame:
        """Points and sites within the radius of each other; ``edge`` may be a part of the sites, with more columns."""
        p, e = _dealt(points, self.edge if edge is None else edge, self.site_blocks, "site_id", "_sb")
        e, p = _dealt(e, p, self.point_blocks, "point_id", "_pb")
        keys = [*KEY, *[c for c in ("_sb", "_pb") if c in p.columns]]
        dx, dy = F.col("x") - F.col("sx"), F.col("y") - F.col("sy")
        d = F.sqrt(dx * dx + dy * dy)
        return p.join(e, keys).withColumn("distance", d).where(F.col("distance") <= self.tree.r).drop("_sb", "_pb")

    def _met(self, points: DataFrame, edge: DataFrame, columns: list[str], others: list[str], run, schema: str) -> DataFrame:
        """``run(points, sites)`` of each leaf's points and each block of its sites, in a task."""
        p, e = _dealt(points, edge, self.site_blocks, "site_id", "_sb")
        e, p = _dealt(e, p, self.point_blocks, "point_id", "_pb")
        keys = [*KEY, *[c for c in ("_sb", "_pb") if c in p.columns]]
        names = [f.split()[0] for f in schema.split(", ")]

        def both(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            return run(mine, theirs) if len(mine) and len(theirs) else pd.DataFrame({c: [] for c in names})

        return p.select(*keys, *columns).groupBy(*keys).cogroup(e.select(*keys, *others).groupBy(*keys)).applyInPandas(both, schema)

    def per_site(self, points: DataFrame, edge: DataFrame) -> DataFrame:
        """(sx, sy, n): the sum of ``w`` over the points of compared leaves within the radius of each site that has any."""
        r = self.tree.r

        def run(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            sx, sy = theirs["sx"].to_numpy(), theirs["sy"].to_numpy()
            n = _seen(sx, sy, *(mine[c].to_numpy() for c in ("x", "y", "w")), r)[0]
            return pd.DataFrame({"sx": sx, "sy": sy, "n": n})[n > 0]

        return self._met(points, edge, ["x", "y", "w"], ["sx", "sy"], run, "sx double, sy double, n long").groupBy("sx", "sy").agg(F.sum("n").alias("n"))

    def per_point(self, points: DataFrame, edge: DataFrame) -> DataFrame:
        """(x, y, n, nearest, least): of each point with a site in range in a compared leaf, the sum of the sites' ``w``, the least distance and the least ``v`` (null: none)."""
        r = self.tree.r

        def run(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            x, y = mine["x"].to_numpy(), mine["y"].to_numpy()
            n, least, near = _seen(x, y, *(theirs[c].to_numpy() for c in ("sx", "sy", "w")), r, theirs["v"].fillna(np.inf).to_numpy(dtype=np.float64), True)
            return pd.DataFrame({"x": x, "y": y, "n": n, "nearest": near, "least": least})[n > 0]

        met = self._met(points, edge, ["x", "y"], ["sx", "sy", "w", "v"], run, "x double, y double, n long, nearest double, least double")
        met = met.groupBy("x", "y").agg(F.sum("n").alias("n"), F.min("nearest").alias("nearest"), F.min("least").alias("least"))
        return met.withColumn("least", F.when(F.col("least") < float("inf"), F.col("least")))


def _places(rows: DataFrame, name: str, *more: Column) -> DataFrame:
    """Every finite place once: (``name``, x, y, w, any others), the place itself as id and the number of its rows."""
    rows = rows.where(F.abs("x") + F.abs("y") < F.lit(float("inf")))
    return rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"), *more).withColumn(name, F.struct("x", "y"))


def radius_reach(points: DataFrame, sites: DataFrame, r: float, least: str | None = None, pid: str = "point_id", leaf: int = SPAN, block: int = SPAN) -> DataFrame:
    """J8, reduced: (point, n, nearest, least) of every point row with a site in range: the number of its pairs, their least
    distance and, of the number ``least`` of the sites, the smallest.  All pairs are met, equal places once; none leaves its task."""
    sites = sites.withColumn("v", (F.col(least) if least else F.lit(None)).cast("double"))
    at = _places(sites, "site_id", F.min("v").alias("v"))
    tree = Quadtree(_places(points, "point_id"), r, leaf)
    _, edge = tree.relate(at, settle=False)
    edge = cut_lineage(edge.join(at.select("site_id", "w", "v"), "site_id"))
    met = Edges(tree, edge, block).per_point(tree.points, edge)
    return points.select(pid, "x", "y").join(met, ["x", "y"]).select(pid, "n", "nearest", "least")


def radius_join(points: DataFrame, sites: DataFrame, r: float, pid: str = "point_id", sid: str = "site_id", leaf: int = LEAF, block: int = BLOCK,
                reduced: bool = False, least: str | None = None) -> DataFrame:
    """(point, site, distance) of all pairs within ``r``; no place, however dense, is one task.  ``reduced``: ``radius_reach``."""
    if reduced:
        return radius_reach(points, sites, r, least, pid, max(leaf, SPAN), max(block, SPAN))
    tree = Quadtree(points.select(F.col(pid).alias("point_id"), "x", "y"), r, leaf)
    _, edge = tree.relate(sites.select(F.col(sid).alias("site_id"), "x", "y"), settle=False)
    return Edges(tree, edge, block).near(tree.points).select(F.col("point_id").alias(pid), F.col("site_id").alias(sid), "distance")


def _counts(edges: Edges, points: DataFrame, whole: DataFrame, edge: DataFrame | None = None) -> DataFrame:
    """(sx, sy, n): the sum of ``w`` over ``points`` in range of each site place; places with none are left out."""
    at_leaf = points.groupBy(*KEY).agg(F.sum("w").alias("c"))
    at_node = edges.tree.ancestors(at_leaf).groupBy("up").agg(F.sum("c").alias("n")).select("up.*", "n")
    settled = whole.join(at_node, KEY).groupBy("site_id").agg(F.sum("n").alias("n")).select(F.col("site_id.x").alias("sx"), F.col("site_id.y").alias("sy"), "n")
    met = edges.per_site(points, edges.edge if edge is None else edge)
    return settled.unionByName(met).groupBy("sx", "sy").agg(F.sum("n").cast("long").alias("n"))


def range_counts(points: DataFrame, sites: DataFrame, r: float, pid: str = "point_id", sid: str = "site_id", leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """(site, n): the number of points within ``r`` of every site that has one; equal places are looked at once, and pairs are met
    only along the circles' edges, inside a task."""
    tree = Quadtree(_places(points, "point_id"), r, leaf)
    whole, edge = tree.relate(_places(sites, "site_id"))
    counts = _counts(Edges(tree, cut_lineage(edge), block), tree.points, whole)
    rows = sites.select(F.col(sid).alias("site_id"), F.col("x").alias("sx"), F.col("y").alias("sy"))
    return rows.join(counts, ["sx", "sy"]).groupBy(F.col("site_id").alias(sid)).agg(F.sum("n").cast("long").alias("n"))


def _covered(edges: Edges, points: DataFrame, whole: DataFrame, edge: DataFrame) -> DataFrame:
    """The ids (places) of ``points`` in range of a site, from nodes in range and comparisons in the other leaves."""
    nodes = whole.select(F.struct(*KEY).alias("up")).distinct()
    tree = edges.tree
    leaves = tree.ancestors(tree.nodes.where("leaf").select(*KEY)).join(nodes, "up", "left_semi").select(*KEY).distinct()
    inside = points.join(leaves, KEY, "left_semi").select("point_id")
    open_edge = edge.join(leaves, KEY, "left_anti")
    one = open_edge.select("*", F.lit(1).cast("long").alias("w"), F.lit(None).cast("double").alias("v"))
    return inside.unionByName(edges.per_point(points.join(leaves, KEY, "left_anti"), one).select(F.struct("x", "y").alias("point_id")))


def coverage(points: DataFrame, sites: DataFrame, r: float, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """The rows of ``points`` (x, y, any others) with no site (x, y) within ``r``; equal places are looked at once, and a null
    or non-finite one is in range of nothing."""
    finite = F.abs("x") + F.abs("y") < F.lit(float("inf"))
    places = points.select("x", "y").where(finite).distinct().withColumn("point_id", F.struct("x", "y"))
    tree = Quadtree(places, r, leaf)
    whole, edge = tree.relate(sites.select("x", "y").where(finite).distinct().withColumn("site_id", F.xxhash64("x", "y")))
    covered = _covered(Edges(tree, edge, block), tree.points, whole, edge).select(F.col("point_id.x").alias("x"), F.col("point_id.y").alias("y"))
    return points.join(covered, ["x", "y"], "left_anti").select(*points.columns)


def _share(df: DataFrame, r: float) -> DataFrame:
    """Adds the square (bx, by) of a side just above ``r``: places in reach of each other are in squares side by side, and sites
    that share a point are at most two squares apart, whatever is rounded."""
    side = r * (1 + 1e-6)
    return df.withColumn("bx", F.floor(F.col("x") / side).cast("long")).withColumn("by", F.floor(F.col("y") / side).cast("long"))


def _around(df: DataFrame, steps: int) -> DataFrame:
    """Every row once for each square at most ``steps`` away."""
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-steps, steps + 1) for j in range(-steps, steps + 1)])
    return df.withColumn("_o", F.explode(near)).withColumn("bx", F.col("bx") + F.col("_o.i")).withColumn("by", F.col("by") + F.col("_o.j")).drop("_o")


def greedy_cover(points: DataFrame, sites: DataFrame, r: float, max_sites: int | None = None, leaf: int = SPAN, block: int = SPAN) -> DataFrame:
    """(pick, site_id, n): repeatedly the site that covers most uncovered points (ties: smallest id).

    Counts only fall, so a site that is first among all that may share a point with it will be picked before any of them;
    all such sites are picked in one round.  Every site is counted once; a round then counts the points that its picks
    cover, near those picks alone, and takes them off, so a point is counted once before and once after it is covered,
    however many rounds there are.  Equal places are one.  Rounds go on until no point in range of a site is left;
    ordering the picks by their counts, then ids, gives the order of one-by-one picking.  A row of a point or site that
    comes twice counts twice, as in a join.  ``max_sites``, if given, keeps the first picks.
    """
    from lodestar.operators.prefix import global_row_number

    tree = Quadtree(_share(_places(points, "point_id"), r), r, leaf)
    whole, edge = tree.relate(_places(sites, "site_id"))
    whole, edge, left = cut_lineage(whole), cut_lineage(edge), cut_lineage(tree.points)
    edges = Edges(tree, edge, block)
    finite = sites.where(F.abs("x") + F.abs("y") < F.lit(float("inf")))
    rows = _share(finite.groupBy("site_id", "x", "y").agg(F.count(F.lit(1)).alias("m")), r)
    counts = _counts(edges, left, whole).select(F.col("sx").alias("x"), F.col("sy").alias("y"), F.col("n").alias("c"))
    alive = cut_lineage(rows.join(counts, ["x", "y"]))
    several = alive.groupBy("site_id").count().where("count > 1").limit(1).count() > 0
    empty = alive.select("site_id", F.col("c").alias("n")).limit(0)
    picks = None
    while True:
        if several:  # a site of several places
            n = alive.groupBy(F.col("site_id").alias("_id")).agg(F.sum(F.col("m") * F.col("c")).alias("n"))
            ranked = alive.join(n, F.col("site_id").eqNullSafe(F.col("_id"))).drop("_id")
        else:
            ranked = alive.withColumn("n", F.col("m") * F.col("c"))
        ranked = ranked.withColumn("rank", F.struct("n", (-F.col("site_id")).alias("first")))
        top = _around(ranked.groupBy("bx", "by").agg(F.max("rank").alias("top")), 2).groupBy("bx", "by").agg(F.max("top").alias("top"))
        here = ranked.join(top, ["bx", "by"]).withColumn("wins", F.col("rank").eqNullSafe(F.col("top")))
        if several:
            won_ids = here.groupBy(F.col("site_id").alias("_id")).agg(F.min("wins").alias("_wins")).where("_wins").select("_id")
            here = here.join(won_ids, F.col("site_id").eqNullSafe(F.col("_id"))).drop("_id")
        won = cut_lineage(here.where("wins").select("site_id", "n", "x", "y", "bx", "by"))
        n_won = won.count()
        if not n_won:
            break
        own = won.select("site_id", "n").distinct()
        picks = own if picks is None else picks.unionByName(own)
        discs = _around(won.select(F.col("x").alias("wx"), F.col("y").alias("wy"), "bx", "by"), 1).withColumnsRenamed({"bx": "_bx", "by": "_by"})
        discs = F.broadcast(discs) if n_won <= TOLD else discs
        dx, dy = F.col("x") - F.col("wx"), F.col("y") - F.col("wy")
        hit = (F.col("bx") == F.col("_bx")) & (F.col("by") == F.col("_by")) & (F.sqrt(dx * dx + dy * dy) <= r)
        gone = cut_lineage(left.join(discs, hit, "left_semi"))
        left = cut_lineage(left.join(discs, hit, "left_anti"))
        # only sites near a pick lose points; only their circles are looked at
        near = _around(won.select("bx", "by"), 2).distinct()
        near = F.broadcast(near) if n_won <= TOLD else near
        met = alive.join(near, ["bx", "by"], "left_semi").select(F.struct("x", "y").alias("site_id")).distinct()
        touched = gone.select(*KEY).distinct()
        lost = _counts(edges, gone, whole.join(met, "site_id", "left_semi"), edge.join(touched, KEY, "left_semi").join(met, "site_id", "left_semi"))
        lost = lost.select(F.col("sx").alias("x"), F.col("sy").alias("y"), F.col("n").alias("_lost"))
        alive = cut_lineage(alive.join(lost, ["x", "y"], "left").withColumn("c", F.col("c") - F.coalesce("_lost", F.lit(0))).drop("_lost").where("c > 0"))
    out = global_row_number(empty if picks is None else picks, [("n", False), ("site_id", True)], "pick").select("pick", "site_id", "n")
    return out if max_sites is None else out.where(F.col("pick") <= max_sites)
