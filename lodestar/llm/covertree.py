"""Embedding near-duplicates: exact cosine threshold pairs by dual traversal of cover trees."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches
from lodestar.llm.forest import Forest
from lodestar.operators.network import connected
from lodestar.session import cut_lineage

#: Vectors that the cells of the large labels are chosen from at most; every vector is then put in a cell.
FIT_ROWS = 8192
#: Vectors that a cell is meant to hold; a label with fewer is one cell.
CELL = 2048
#: Vectors of a cell that one tree holds at most; a fuller cell has several trees.
BLOCK = 4096
#: Slack on distances, so that rounding never prunes a link.
SLACK = 1e-7


def unit_vector(values) -> bytes | None:
    """The vector at length 1 as 64-bit floats, or None if it is null, zero, or has null or non-finite components."""
    if values is None or len(values) == 0:
        return None
    try:
        v = np.asarray(values, dtype=np.float64)
    except (TypeError, ValueError):
        return None
    if not np.isfinite(v).all() or not (top := np.abs(v).max()):
        return None
    v = v / top  # keeps the squares of huge and tiny numbers in range
    return (v / math.sqrt(float(v @ v)) + 0.0).tobytes()


def chord(cosine: float) -> float:
    """The distance of two unit vectors with this cosine."""
    return math.sqrt(max(0.0, 2 - 2 * cosine))


def spread(x: np.ndarray, limit: int, least: float):
    """Farthest-first centres: yields (centres, owner, distance) at each level, whose radii halve.

    A level is left out once it would need more than ``limit`` centres; no level follows one with a
    radius of at most ``least``.
    """
    centres, owner = [0], np.zeros(len(x), dtype=np.int64)
    dist = np.linalg.norm(x - x[0], axis=1)
    yield centres[:], owner.copy(), dist.copy()
    radius = dist.max() / 2
    while dist.max() > least:
        while (far := int(dist.argmax())) is not None and dist[far] > radius:
            if len(centres) >= limit:
                return
            d = np.linalg.norm(x - x[far], axis=1)
            near = d < dist
            owner[near], dist[near] = len(centres), d[near]
            centres.append(far)
        yield centres[:], owner.copy(), dist.copy()
        radius /= 2


class CoverTree:
    """Nested levels of centres with halving radii over unit vectors.

    Every centre of a level is one of the next; a node's radius is the largest distance to a point
    below it.  Points hang under the nodes of the last level.
    """

    def __init__(self, x: np.ndarray, threshold: float):
        self.x = x
        levels = list(spread(x, max(8, len(x) // 48), threshold / 4))
        self.centres = [np.array(c) for c, _, _ in levels]
        # the owner of the next level's centres is their parent; a node may take in points that are
        # nearer to another centre of its level, so its radius is measured from the points below it
        above = [owner[np.array(levels[i + 1][0])] for i, (_, owner, _) in enumerate(levels[:-1])]
        node = levels[-1][1]
        order = np.argsort(node, kind="stable")
        self.members = np.split(order, np.cumsum(np.bincount(node, minlength=len(self.centres[-1])))[:-1])
        self.children = [[np.flatnonzero(up == j) for j in range(len(c))] for c, up in zip(self.centres, above)]
        self.radius: list[np.ndarray] = [None] * len(levels)
        for i in range(len(levels) - 1, -1, -1):
            far = np.linalg.norm(x - x[self.centres[i][node]], axis=1)
            self.radius[i] = np.zeros(len(self.centres[i]))
            np.maximum.at(self.radius[i], node, far)
            if i:
                node = above[i - 1][node]

    def down(self, level: int, nodes: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """(level, which of ``nodes``, child) one level lower, or the nodes themselves at the last one."""
        if level == len(self.children):
            return level, np.arange(len(nodes)), nodes
        kids = [self.children[level][j] for j in nodes]
        return level + 1, np.repeat(np.arange(len(nodes)), list(map(len, kids))), np.concatenate(kids)


def leaf_pairs(a: CoverTree, b: CoverTree, threshold: float):
    """Pairs of last-level nodes that may hold points within ``threshold``: the dual traversal.

    A pair of nodes is dropped with all below it when its centres are further apart than both radii
    and the threshold together.
    """
    la = lb = 0
    i, j = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    while True:
        apart = np.empty(len(i))
        for at in range(0, len(i), 1 << 14):
            s = slice(at, at + (1 << 14))
            apart[s] = np.linalg.norm(a.x[a.centres[la][i[s]]] - b.x[b.centres[lb][j[s]]], axis=1)
        near = apart <= a.radius[la][i] + b.radius[lb][j] + threshold + SLACK
        i, j = i[near], j[near]
        if not len(i) or la == len(a.children) and lb == len(b.children):
            return zip(i.tolist(), j.tolist())
        la, at, i = a.down(la, i)
        lb, again, j = b.down(lb, j[at])
        i = i[again]


def compare(a: CoverTree, wa: np.ndarray, na: np.ndarray, b: CoverTree, wb: np.ndarray, nb: np.ndarray, cosine: float,
            count_a: np.ndarray, count_b: np.ndarray, forest: Forest) -> list[tuple[int, int]]:
    """Adds to each point's count the weights of the points it links with; returns links that join trees of ``forest``.

    ``a is b`` compares a tree with itself and counts every link once from each end.
    """
    out = []
    same = a is b
    for i, j in leaf_pairs(a, b, chord(cosine)):
        if same and j < i:
            continue
        mi, mj = a.members[i], b.members[j]
        hit = a.x[mi] @ b.x[mj].T >= cosine
        if same and i == j:
            np.fill_diagonal(hit, False)
        if not hit.any():
            continue
        count_a[mi] += hit @ wb[mj]
        if not (same and i == j):
            count_b[mj] += hit.T @ wa[mi]
        if hit.all():
            pairs = [(na[mi[0]], n) for n in nb[mj]] + [(n, nb[mj[0]]) for n in na[mi]]
        else:
            r, c = np.nonzero(hit)
            pairs = zip(na[mi[r]].tolist(), nb[mj[c]].tolist())
        out += [(int(p), int(q)) for p, q in pairs if forest.add(int(p), int(q))]
    return out


def cells(sample: dict, sizes: dict) -> dict:
    """Centres of the cells of each large label: farthest-first over its sample, at most one for each ``CELL`` vectors."""
    found = {}
    for key, x in sample.items():
        n = min(len(x), math.ceil(sizes[key] / CELL))
        level = [c for c, _, _ in spread(x, n, 0.0)][-1]
        found[key] = x[level + [i for i in range(len(x)) if i not in set(level)][:n - len(level)]]
    return found


def _assign(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances to all centres, and the nearest one."""
    d = np.sqrt(np.maximum(0, 2 - 2 * x @ centres.T))
    return d, d.argmin(1)


def links(reps: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """(counts, edges) of distinct vectors ``reps`` (node, label, dim, unit, n, size); ``size`` is the number of
    distinct vectors of the label.

    ``counts`` (node, links): number of vectors of other nodes at this cosine or more.  ``edges``
    (a, b): links that connect what all links connect.

    The largest labels are cut into cells around centres chosen from a bounded sample; any other label is
    one cell, in as many blocks as its size asks for.  A vector's home is
    the nearest centre's cell; it also visits each later cell that may hold a partner: one whose
    covering radius reaches it, and whose centre is not further than the home's by more than twice
    the threshold, as any partner living there is nearest to that centre.  A cell's home vectors, in
    blocks, are built into cover trees; everything that visits streams past them.  So each pair of
    vectors is compared once, every task holds one block and one batch, and nothing is left out.
    """
    limit = chord(cosine)
    sizes = reps.groupBy("label", "dim").agg(F.first("size").alias("size")).where(F.col("size") > CELL)
    large = {(r.label, r.dim): r["size"] for r in sizes.orderBy(F.desc("size"), "label", "dim").limit(FIT_ROWS // 64).collect()}
    centres, radius, homes = {}, {}, {}
    if large:
        total = sum(large.values())
        keep = F.col("label").isin(sorted({k[0] for k in large}))
        part = min(1.0, 0.9 * FIT_ROWS / total)
        rank = F.xxhash64("unit")
        some = reps.where(keep & (F.shiftrightunsigned(rank, 11).cast("double") < part * float(1 << 53))).orderBy(rank).limit(FIT_ROWS)
        sample: dict = {}
        for r in some.select("label", "dim", "unit").toLocalIterator():
            if (r.label, r.dim) in large:
                sample.setdefault((r.label, r.dim), []).append(np.frombuffer(bytes(r.unit)))
        centres = cells({k: np.array(v) for k, v in sample.items()}, large)

        def make_radii():
            def one(batch: pa.RecordBatch):
                out = {}
                for key, rows, x in _by_label(batch):
                    if key in centres:
                        d, at = _assign(x, centres[key])
                        for c in range(len(centres[key])):
                            if (at == c).any():
                                out[(*key, c)] = (float(d[at == c, c].max()), int((at == c).sum()))
                ks = list(out)
                return {"label": [k[0] for k in ks], "dim": [k[1] for k in ks], "cell": [k[2] for k in ks],
                        "radius": [out[k][0] for k in ks], "n": [out[k][1] for k in ks]}
            return one

        schema = f"label {reps.schema['label'].dataType.simpleString()}, dim int, cell int, radius double, n long"
        found = map_batches(reps.where(keep).select("node", "label", "dim", "unit", "n"), schema, make_radii)
        for r in found.groupBy("label", "dim", "cell").agg(F.max("radius").alias("radius"), F.sum("n").alias("n")).collect():
            radius[r.label, r.dim, r.cell], homes[r.label, r.dim, r.cell] = r.radius, r.n

    def make_visits():
        def one(batch: pa.RecordBatch):
            rows, cell, block, guest = [], [], [], []

            def put(r, c, b, g):
                rows.append(r)
                cell.append(np.full(len(r), c, dtype=np.int32))
                block.append(b.astype(np.int32) if isinstance(b, np.ndarray) else np.full(len(r), b, dtype=np.int32))
                guest.append(np.full(len(r), g, dtype=np.int32))

            node = batch.column(0).to_numpy()
            for key, own, x in _by_label(batch):
                if key not in centres:
                    nb = math.ceil(batch.column(5)[int(own[0])].as_py() / BLOCK)
                    mine = node[own] % nb
                    put(own, 0, mine, 0)
                    for b in range(nb - 1):
                        put(own[mine > b], 0, b, 1)
                    continue
                d, at = _assign(x, centres[key])
                home = d[np.arange(len(x)), at]
                for c in range(len(centres[key])):
                    if (*key, c) not in radius:
                        continue
                    nb = math.ceil(homes[(*key, c)] / BLOCK)
                    here = at == c
                    mine = node[own] % nb
                    put(own[here], c, mine[here], 0)
                    for b in range(nb - 1):
                        put(own[here & (mine > b)], c, b, 1)
                    visit = (at < c) & (d[:, c] <= np.minimum(radius[(*key, c)] + limit, home + 2 * limit) + SLACK)
                    for b in range(nb if visit.any() else 0):
                        put(own[visit], c, b, 1)
            r = pa.array(np.concatenate(rows))
            return {n: batch.column(i).take(r) for i, n in enumerate(("node", "label", "dim", "unit", "n"))} | {
                "cell": np.concatenate(cell), "block": np.concatenate(block), "guest": np.concatenate(guest)}
        return one

    base = reps.select("node", "label", "dim", "unit", "n", "size")
    schema = base.drop("size").select("*", *[F.lit(0).alias(c) for c in ("cell", "block", "guest")]).schema
    group = ["label", "dim", "cell", "block"]
    visits = (map_batches(base, schema, make_visits).repartition(*group).sortWithinPartitions(*group, "guest", "node")
              .select("node", "unit", "n", "label", "dim", "cell", "block", "guest"))

    def run(batches):
        work = _Stream(cosine)
        for batch in batches:
            if batch.num_rows:
                yield from work.add(batch)
        yield from work.end()

    met = cut_lineage(visits.mapInArrow(run, "a long, b long, links long"))
    counts = met.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")
    return counts, met.where("b IS NOT NULL").select("a", "b")


def _by_label(batch: pa.RecordBatch):
    """(key, row numbers, vectors) of each label and length in a batch of (node, label, dim, unit, ...)."""
    keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
    rows: dict = {}
    for i, k in enumerate(keys):
        rows.setdefault(k, []).append(i)
    for k, r in rows.items():
        yield k, np.array(r), np.array([np.frombuffer(batch.column(3)[i].as_py()) for i in r])


class _Stream:
    """Rows sorted by group, home before guests: a tree of the home rows, met by the guests batch by batch."""

    GUESTS = 2048

    def __init__(self, cosine: float):
        self.cosine, self.limit = cosine, chord(cosine)
        self.key, self.home, self.guests, self.tree = None, [], [], None

    def _columns(self, rows):
        return (np.array([np.frombuffer(r[1]) for r in rows]), np.array([r[0] for r in rows], dtype=np.int64),
                np.array([r[2] for r in rows], dtype=np.int64))

    def _batch(self, edges, node, count):
        some = count > 0
        a = [e[0] for e in edges] + node[some].tolist()
        b = [e[1] for e in edges] + [None] * int(some.sum())
        n = [None] * len(edges) + count[some].tolist()
        return pa.RecordBatch.from_arrays([pa.array(v, type=pa.int64()) for v in (a, b, n)], names=["a", "b", "links"])

    def _build(self):
        x, self.node, self.weight = self._columns(self.home)
        self.home, self.forest = [], Forest()
        self.tree = CoverTree(x, self.limit)
        self.count = np.zeros(len(x), dtype=np.int64)
        edges = compare(self.tree, self.weight, self.node, self.tree, self.weight, self.node, self.cosine, self.count, self.count, self.forest)
        return self._batch(edges, self.node[:0], self.count[:0])

    def _meet(self):
        x, node, weight = self._columns(self.guests)
        self.guests = []
        count = np.zeros(len(x), dtype=np.int64)
        edges = compare(self.tree, self.weight, self.node, CoverTree(x, self.limit), weight, node, self.cosine, self.count, count, self.forest)
        return self._batch(edges, node, count)

    def _close(self):
        if self.home:
            yield self._build()
        if self.guests and self.tree is not None:
            yield self._meet()
        if self.tree is not None:
            yield self._batch([], self.node, self.count)
        self.tree, self.guests = None, []

    def add(self, batch: pa.RecordBatch):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[3:7] != self.key:
                yield from self._close()
                self.key = row[3:7]
            if not row[7]:
                self.home.append(row)
                continue
            if self.home:
                yield self._build()
            if self.tree is not None:
                self.guests.append(row)
                if len(self.guests) >= self.GUESTS:
                    yield self._meet()

    def end(self):
        yield from self._close()


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", label: str = "label",
                    vector: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    Vectors link when their labels are equal and not null and their cosine, in double precision, is at
    least ``cosine``.  Vectors that are null, empty or zero, or hold null or non-finite components, and
    vectors of different lengths, link with nothing.  Equal vectors of a label are compared as one and
    counted as many.  Null ids are left out of the smallest id.  Repeated rows are vectors of their
    own; an empty table gives no rows.
    """
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in (id_col, label)}

    def make():
        def one(batch: pa.RecordBatch):
            units = [unit_vector(v) for v in batch.column(2).to_pylist()]
            return {"_id": batch.column(0), "label": batch.column(1), "unit": units, "dim": [0 if u is None else len(u) // 8 for u in units]}
        return one

    v = map_batches(vectors.select(id_col, label, vector), f"_id {kinds[id_col]}, label {kinds[label]}, unit binary, dim int", make)
    can = F.col("unit").isNotNull() & F.col("label").isNotNull()
    # vectors are numbered where they are written, so a task that is run again gives the same numbers
    reps = cut_lineage(v.where(can).groupBy("label", "dim", "unit").agg(F.min("_id").alias("least"), F.count(F.lit(1)).alias("n")))
    reps = reps.withColumn("node", F.monotonically_increasing_id())
    sizes = reps.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size"))
    reps = cut_lineage(reps.join(sizes, ["label", "dim"]))
    counts, edges = links(reps, cosine)
    joined = connected(edges)
    found = (reps.join(counts, "node", "left").join(joined, "node", "left")
             .select("label", "dim", "unit", "least", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")))
    ids = found.groupBy("root").agg(F.min("least").alias("component"))
    found = found.join(ids, "root").select("label", "dim", "unit", "component", (F.col("links") + F.col("n") - 1).alias("links"))
    linked = v.where(can).join(found, ["label", "dim", "unit"]).select("_id", "links", "component")
    alone = v.where(~can).select("_id", F.lit(0).cast("long").alias("links"), F.col("_id").alias("component"))
    return linked.union(alone).select(F.col("_id").alias(id_col), F.col("links").alias("n_links"),
                                      F.col("component").alias("component_id"), F.col("_id").eqNullSafe(F.col("component")).alias("kept"))
