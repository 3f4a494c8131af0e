"""Range operators where nearly all points lie in one place."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import spatial


@pytest.fixture(scope="module")
def places(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0.5, 0.05, (900, 2)), rng.uniform(-3, 3, (60, 2)), np.tile([[0.25, -0.125]], (240, 1))])
    s = np.vstack([rng.normal(0.6, 0.3, (90, 2)), rng.uniform(-3, 3, (40, 2)), [[0.25, 0.175], [1e6, 0.0], [-0.05, -0.125]]])
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)] + [(9001, None, 1.0), (9002, float("nan"), 0.0)],
                                   "point_id long, x double, y double")
    sites = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(s)] + [(9003, None, None)], "site_id long, x double, y double")
    return points, sites, np.sqrt(((x[:, None] - s[None]) ** 2).sum(axis=2))


@pytest.mark.parametrize("r", [0.3, 1.0])
def test_ranges_over_a_dense_place(places, r):
    points, sites, d = places
    near, small = d <= r, {"leaf": 64, "block": 20}
    got = spatial.radius_join(points, sites, r, **small).collect()
    assert sorted((a.point_id, a.site_id) for a in got) == sorted(map(tuple, np.argwhere(near).tolist()))
    assert all(abs(a.distance - d[a.point_id, a.site_id]) < 1e-12 for a in got)
    counts = {a.site_id: a.n for a in spatial.range_counts(points, sites, r, **small).collect()}
    assert counts == {j: int(n) for j, n in enumerate(near.sum(axis=0)) if n}
    some = sites.where("site_id % 7 = 0")
    left = sorted(a.point_id for a in spatial.coverage(points, some, r, **small).collect())
    assert left == [i for i in range(len(d)) if not near[i, ::7].any()] + [9001, 9002]


def test_cover_of_a_dense_place(places):
    points, sites, d = places
    near, left, want = d <= 0.5, np.ones(len(d), dtype=bool), []
    while (n := near[left].sum(axis=0)).any():
        want.append((len(want) + 1, int(n.argmax()), int(n.max())))
        left &= ~near[:, n.argmax()]
    assert [tuple(a) for a in spatial.greedy_cover(points, sites, 0.5, leaf=200, block=50).orderBy("pick").collect()] == want
    assert [tuple(a) for a in spatial.greedy_cover(points, sites, 0.5, max_sites=2).orderBy("pick").collect()] == want[:2]


def test_nodes_settle_instead_of_pairs(places):
    points, sites, d = places
    tree = spatial.Quadtree(points, 1.0, 64)
    whole, edge = tree.relate(sites)
    assert tree.levels > 3
    assert spatial.Edges(tree, edge).near(tree.points).count() < (d <= 1.0).sum() / 3
    big = tree.nodes.where("leaf and n > 64").collect()
    assert [r.n for r in big] == [240] and tree.crowded and tree.levels < 12


def test_no_points_or_no_sites(places):
    points, sites, _ = places
    none_p, none_s = points.limit(0), sites.limit(0)
    for p, s in ((none_p, sites), (points, none_s), (none_p, none_s)):
        assert spatial.radius_join(p, s, 1.0).count() == 0 and spatial.range_counts(p, s, 1.0).count() == 0
        assert spatial.greedy_cover(p, s, 1.0).count() == 0
        assert spatial.coverage(p, s, 1.0).count() == p.count()


def test_pairs_stay_inside_their_task(places, monkeypatch):
    """Counts, covers and reduced joins send on one number for each place, never pairs; equal places are one."""
    points, sites, d = places
    monkeypatch.setattr(spatial.Edges, "near", None)
    near = d <= 1.0
    counts = {a.site_id: a.n for a in spatial.range_counts(points, sites, 1.0).collect()}
    assert counts == {j: int(n) for j, n in enumerate(near.sum(axis=0)) if n}
    ranked = sites.withColumn("pick", F.when(F.col("site_id") % 3 == 0, 1000 - F.col("site_id")))
    got = {a.point_id: a for a in spatial.radius_join(points, ranked, 1.0, reduced=True, least="pick").collect()}
    assert set(got) == set(np.flatnonzero(near.any(axis=1)).tolist())
    for i, a in got.items():
        seen = np.flatnonzero(near[i])
        assert a.n == len(seen) and abs(a.nearest - d[i].min()) < 1e-12
        assert a.least == min((1000 - j for j in seen if j % 3 == 0), default=None)
    assert spatial.greedy_cover(points, sites, 1.0, max_sites=1).first().n == near.sum(axis=0).max()


def test_equal_places_are_one(spark, monkeypatch):
    seen = []
    made = spatial.Quadtree.__init__
    monkeypatch.setattr(spatial.Quadtree, "__init__", lambda self, points, *rest: (seen.append(points.count()), made(self, points, *rest))[1])
    p = spark.range(3000).selectExpr("id AS point_id", "(id % 5) / 10D AS x", "0D AS y")
    s = spark.range(40).selectExpr("id AS site_id", "(id % 2) / 10D AS x", "0D AS y")
    assert {(a.site_id, a.n) for a in spatial.range_counts(p, s, 0.25).collect()} == {(i, 1800 if i % 2 == 0 else 2400) for i in range(40)}
    assert seen == [5]


def test_cover_with_repeated_rows_null_ids_and_sites_of_two_places(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 0.0), (2, 0.4, 0.0), (3, 5.0, 0.0), (4, 9.0, 0.0), (None, 9.0, 0.1)], "point_id long, x double, y double")
    s = spark.createDataFrame([(7, 0.1, 0.0), (8, 0.1, 0.0), (9, 5.0, 0.0), (9, 9.0, 0.0), (9, 9.0, 0.0), (None, 0.0, 0.0)], "site_id long, x double, y double")
    # 9 covers one row at 5 and two rows twice at 9; 7, 8 and the null id cover three rows each
    assert [tuple(a) for a in spatial.greedy_cover(p, s, 1.0).orderBy("pick").collect()] == [(1, 9, 5), (2, 7, 3)]
