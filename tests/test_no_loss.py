"""Nothing is cut off: long paths and rings, full covers, null keys, huge ids, late files, workers elsewhere."""

import datetime as dt
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.operators import blocks, kernels, layers, linear, network, nets, prefix, sampling, similarity, spatial
from lodestar.session import checkpoint_dir
from lodestar.streaming import bandit
from tests.conftest import SF_SMALL


def test_long_chain_with_a_ring_beside_it(spark):
    chain = [(i, i + 1, 2.0) for i in range(1000)] + [(500, 2000, 1.0), (2000, 501, 0.5)]
    ring = [(5000 + i, 5000 + (i + 1) % 7, 1.0) for i in range(7)]
    e = spark.createDataFrame(chain + ring, "src long, dst long, cost double")
    got = {r.node: r.dist for r in network.shortest_paths(e, 0).collect()}
    want = {i: 2.0 * i if i <= 500 else 1001.5 + 2.0 * (i - 501) for i in range(1001)} | {2000: 1001.0}
    assert got == pytest.approx(want)
    worst = {r.node: r.dist for r in network.bottleneck_paths(e, 0).collect()}
    assert worst[0] == 0.0 and worst[1000] == 2.0 and len(worst) == 1002


def test_random_graph_matches_plain_relaxation(spark):
    rng = np.random.default_rng(1)
    arcs = [(int(a), int(b), float(c)) for a, b, c in zip(rng.integers(0, 60, 150), rng.integers(0, 60, 150), rng.integers(1, 50, 150))]
    dist = {arcs[0][0]: 0.0}
    for _ in range(60):
        for a, b, c in arcs:
            if a in dist and dist[a] + c < dist.get(b, np.inf):
                dist[b] = dist[a] + c
    got = network.shortest_paths(spark.createDataFrame(arcs, "src long, dst long, cost double"), arcs[0][0]).collect()
    assert {r.node: r.dist for r in got} == dist


def test_negative_cycle_is_an_error(spark):
    e = spark.createDataFrame([(1, 2, 1.0), (2, 3, -3.0), (3, 2, 1.0), (3, 4, 1.0)], "src long, dst long, cost double")
    with pytest.raises(ValueError):
        network.shortest_paths(e, 1)


def test_long_tour_is_one_tour(spark):
    arcs = spark.createDataFrame([(i, (i + 1) % 1000, 1) for i in range(1000)], "src long, dst long, cost long")
    t = network.tour_audit(arcs).collect()
    assert {(r.comp, r.arcs, r.in_degree, r.out_degree) for r in t} == {(0, 1000, 1, 1)}


def test_cover_leaves_nothing_and_matches_one_by_one(spark):
    rng = np.random.default_rng(4)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((300, 2)) * 10)]
    sites = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.random((90, 2)) * 10)]
    got = spatial.greedy_cover(spark.createDataFrame(pts, "point_id long, x double, y double"),
                               spark.createDataFrame(sites, "site_id long, x double, y double"), 1.0).orderBy("pick").collect()
    cover = {s: {p for p, px, py in pts if (px - x) ** 2 + (py - y) ** 2 <= 1.0} for s, x, y in sites}
    left, want = set().union(*cover.values()), []
    while left:
        s = min(cover, key=lambda s: (-len(cover[s] & left), s))
        want.append((s, len(cover[s] & left)))
        left -= cover[s]
    assert [(r.site_id, r.n) for r in got] == want


@pytest.mark.parametrize("asc", [True, False])
def test_running_totals_keep_nulls_and_any_type(spark, asc):
    rows = [(None if i % 11 == 0 else f"k{i % 5}", None if i % 7 == 0 else "g" * (i % 3), i, 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, g string, i long, v long")
    got = prefix.running_totals(df, [("k", asc), ("i", True)], {"c": F.col("v")}, partition_by=["g"], n_ranges=9)
    order = F.col("k").asc() if asc else F.col("k").desc()
    want = df.withColumn("c", F.sum("v").over(Window.partitionBy("g").orderBy(order, "i").rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(map(repr, got.select("i", "c").collect())) == sorted(map(repr, want.select("i", "c").collect()))


def test_equal_first_keys_still_spread(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 18_000, 1).otherwise(F.col("id")).alias("k"), "id")
    ranged = prefix.with_range_id(df, [("k", True), ("id", True)], n_ranges=10)
    assert max(r["count"] for r in ranged.groupBy("_range_id").count().collect()) < 6000


def test_hash_order_of_huge_and_text_keys(spark):
    ids = spark.createDataFrame([(2 ** 63 - 1 - i,) for i in range(200)], "k long")
    order = [[r.k for r in ids.orderBy(sampling.hash_order("k", s)).collect()] for s in (0, 5)]
    assert order[0] != order[1] and sorted(order[0]) == sorted(order[1])
    h = ids.select(sampling.hash_order("k").alias("h")).collect()
    assert len({r.h for r in h}) == 200 and all(0 <= r.h < sampling.HASH_MOD for r in h)
    assert spark.createDataFrame([("a",), (None,)], "k string").where(sampling.hash_order("k").isNotNull()).count() == 2


def test_bootstrap_draws_are_poisson_and_stable(spark):
    df = spark.range(20_000)
    a = sampling.bootstrap(df, "id", 1.0, seed=3)
    n = a.count()
    assert abs(n - 20_000) < 600
    assert a.repartition(7).exceptAll(sampling.bootstrap(df.repartition(3), "id", 1.0, seed=3)).count() == 0


def test_samplers_with_a_majority_class(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 100 == 0).cast("int").alias("y"), F.lit("a").alias("c"), F.rand(1).alias("s"))
    hard = sampling.hard_negatives(df, "id", "s", "y")
    assert {r["source"]: r["count"] for r in hard.groupBy("source").count().collect()} == {"positive": 30, "hard": 30, "random": 30}
    capped = sampling.cap_per_class(df, "c", "id", {"a": 17})
    assert capped.count() == 17


def test_only_the_last_bin_of_a_class_is_numbered(spark, monkeypatch):
    from lodestar.operators import prefix

    keys = [("a", i % 3000, i) for i in range(6000)] + [("b", i, i) for i in range(40)] + [(None, i, i) for i in range(9)] + [("c", i, i) for i in range(30)]
    neg = spark.createDataFrame([("d", None, i) for i in range(50)] + keys, "cls string, key long, tie int").repartition(5)
    pos = spark.createDataFrame([("a", 700), ("b", 100), ("c", None), ("d", 7), ("e", 3)], "cls string, n_pos long")
    numbered, number = [], prefix.grouped_row_number
    monkeypatch.setattr(prefix, "grouped_row_number", lambda df, *a: numbered.append(df.count()) or number(df, *a))
    got = sampling.negative_ratio_sample(neg, pos, "cls", "key", 2.5, seed=4, ties=["tie"])
    order = sampling.hash_order("key", 4)
    rows = [tuple(r) for r in neg.select("cls", "key", "tie", order.alias("h")).collect()]
    want = []
    for cls, cap in (("a", 1750), ("b", 250), ("d", 17)):
        want += sorted((r for r in rows if r[0] == cls), key=lambda r: (r[3], r[1] or 0, r[2]))[:cap]
    assert got.columns == ["cls", "key", "tie"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((r[:3] for r in want), key=repr)
    assert numbered[0] < 200


def test_rank_within_class_equals_window(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).alias("c"), (F.col("id") * 7 % 50 / 10.0).alias("d"))
    want = df.withColumn("rank", F.rank().over(Window.partitionBy("c").orderBy("d")))
    got = similarity.rank_within_class(df, "c", "d", "id").select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_block_distances_are_the_sequential_sums():
    rng = np.random.default_rng(0)
    q, c = rng.normal(size=(40, 37)), rng.normal(size=(60, 37))
    want = np.zeros((40, 60))
    for i in range(40):
        for j in range(60):
            s = 0.0
            for x, y in zip(q[i], c[j]):
                s = s + (x - y) * (x - y)
            want[i, j] = s
    assert (blocks.exact_sq_dists(q, c) == want).all()
    row, col = blocks.nearest(want, np.arange(60), 5)
    assert col.reshape(40, 5).tolist() == [np.lexsort((np.arange(60), w))[:5].tolist() for w in want]


@pytest.fixture
def late_files(spark, tmp_path):
    """Three files out of time order, as a table of part files: March first, then two January days; one id comes twice."""
    path = tmp_path / "events.parquet"
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    days = [dt.datetime(2024, 3, 1), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 2)]
    for n, day in enumerate(days):
        rows = [(n * 10 + i, day + dt.timedelta(minutes=i), "arm", float(i * 20)) for i in range(10)] + [(0, days[0], "arm", 0.0)] * (n == 2)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
    return str(tmp_path)


def test_stream_counts_late_rows_in_part_files(spark, late_files):
    before = set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))
    r = bandit.stream_arm_posteriors(spark, late_files, files_per_trigger=1).collect()
    assert [(x.pulls, x.alpha, x.beta) for x in r] == [(30, 22, 10)]
    days = bandit.stream_daily_arm_counts(spark, late_files, files_per_trigger=1).collect()
    assert sorted(x.pulls for x in days) == [10, 10, 10]
    assert not [f for f in set(os.listdir(checkpoint_dir(spark).removeprefix("file:"))) - before if f.startswith("stream-")]


def test_workers_need_not_see_the_package(tmp_path):
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as e; from pyspark.sql import SparkSession; "
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4').getOrCreate(); "
            "print('ROWS', e.queries()['covariance_matrix'](s, %r).count())") % (os.path.dirname(os.path.dirname(os.path.abspath(__file__))), SF_SMALL)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 4096" in out.stdout, out.stderr[-2000:]


def test_layer_gradients_against_differences():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(30, 5)), rng.integers(0, 3, 30)
    for hidden, loss in (("sigmoid", "cross_entropy"), ("relu", "squared"), ("sigmoid", "softplus")):
        net = layers.Layers([5, 7, 6, 3], hidden, loss)
        w = net.start(1)
        g, _ = net.gradient(x, y, w)
        for i in rng.choice(len(w), 30, replace=False):
            d = np.zeros(len(w))
            d[i] = 1e-6
            assert abs((net.gradient(x, y, w + d)[1] - net.gradient(x, y, w - d)[1]) / 2e-6 - g[i]) < 1e-3


def test_a_quadratic_loss_takes_one_scan(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3)) + 2.0
    y = np.column_stack([x @ [1.0, -2.0, 0.5] + 3.0, x[:, 0] - 40.0]) + rng.normal(size=(200, 2))
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y)], "x array<double>, y array<double>").repartition(3)
    net = layers.Layers([3, 2], loss="squared")
    scans, sums = [], nets.array_sums
    monkeypatch.setattr(nets, "array_sums", lambda *a: scans.append(1) or sums(*a))
    for name in nets.STEPS:
        scans.clear()
        step, w, want = nets.STEPS[name](0.05), net.start(1), []
        hist = nets.train(df, net.n_weights, net.gradient, step=nets.STEPS[name](0.05), iters=7, lam=0.1, start=w, free=net.biases())
        assert len(scans) == 1
        for t in range(1, 8):
            g, loss = net.gradient(x, y, w)
            want.append(loss / 200 + 0.05 * float((w[~net.biases()] ** 2).sum()))
            w = step(w, g / 200 + 0.1 * w * ~net.biases(), t)
        assert np.allclose([h["loss"] for h in hist], want, rtol=1e-10)
        assert np.allclose(hist[-1]["weights"], w, rtol=1e-10)


def test_anchor_holds_weights(spark):
    rng = np.random.default_rng(0)
    rows = [([1.0, float(a)], float(a + rng.normal() > 0)) for a in rng.normal(size=300)]
    df = spark.createDataFrame(rows, "x array<double>, y double")
    free = nets.train(df, 2, iters=30)[-1]["weights"]
    tied = nets.train(df, 2, iters=30, anchor=100.0, step=nets.Sgd(0.005))[-1]["weights"]
    assert abs(tied[1]) < 0.1 * abs(free[1])


def test_landmark_features_reproduce_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 3))
    phi = kernels.Landmarks(x, 1.5).features(x)
    assert np.allclose(phi @ phi.T, kernels.gaussian(x, x, 1.5), atol=1e-6)


def test_ridge_is_blind_to_units(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = x @ [1.0, 2.0] + rng.normal(size=200)
    a = spark.createDataFrame([(float(p), float(q), float(r)) for (p, q), r in zip(x, y)], "a double, b double, y double")
    b = a.withColumn("b", F.col("b") * 1000 + 1e6)
    one, two = (linear.ridge_path(d, "y", ["a", "b"], [50.0])[0][1] for d in (a, b))
    assert one[1] == pytest.approx(two[1], rel=1e-6) and one[2] == pytest.approx(1000 * two[2], rel=1e-6)


@pytest.mark.parametrize("cell_rows,block", [(4096, 4096), (20, 4096), (30, 16)])
def test_knn_join_prunes_without_loss(spark, monkeypatch, cell_rows, block):
    monkeypatch.setattr(similarity, "CELL_ROWS", block)
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(12, 4)) * 5, 25, axis=0) + rng.normal(size=(300, 4)) * 0.2
    x[:40] = x[0]  # many equal vectors
    rows = [(i, [float(a) for a in r], i % 3) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, label int")
    got = similarity.knn_join(df, df, 6, exclude_self=True, carry=[("label", "int")], cell_rows=cell_rows).collect()
    d = blocks.exact_sq_dists(x, x)
    np.fill_diagonal(d, np.inf)
    want = {(i, int(j), n + 1, int(j) % 3) for i in range(300) for n, j in enumerate(np.lexsort((np.arange(300), d[i]))[:6])}
    assert {(r.query_id, r.neighbour_id, r.rank, r.label) for r in got} == want
    few = similarity.knn_join(df, df.limit(3), 6, cell_rows=2).groupBy("query_id").count().collect()
    assert len(few) == 300 and {r["count"] for r in few} == {3}
    assert similarity.knn_join(df, df.where("false"), 6).count() == 0


def test_blocks_of_large_tables_are_few():
    """What moves in a product of tables is their rows once for each block of the other."""
    assert blocks.grid(600_000, 600_000, 12) == (10, 10)
    assert blocks.grid(100_000, 100_000, 12) == (5, 5)
    assert blocks.grid(0, 300, 12) == (1, 2)


@pytest.mark.parametrize("cell_rows", [3, 40, 4096])
def test_k_nearest_is_the_whole_product(cell_rows):
    rng = np.random.default_rng(1)
    for t in range(24):
        n, m, k = rng.integers(1, 400, 2).tolist() + [int(rng.integers(1, 12))]
        q = rng.integers(-2, 3, size=(n, 3)).astype(float) if t % 2 else rng.normal(size=(n, 3)) * 10.0 ** rng.integers(-3, 6)
        c = q[rng.integers(0, n, size=m)] + (0 if t % 3 else rng.normal(size=(m, 3)) * 1e-7)
        if t % 5 == 0:
            c[0], q[0, 0] = np.nan, np.inf
        if t % 7 == 0:
            q[-1], c[-1] = 1e200, -1e200
        q_ids, c_ids, own = np.arange(n), rng.permutation(m), bool(t % 2)
        with np.errstate(over="ignore", invalid="ignore"):
            d = blocks.exact_sq_dists(q, c)
            d[(q_ids[:, None] == c_ids[None, :]) & own] = np.inf
            row, col = blocks.nearest(d, c_ids, k)
            r, i, d2 = blocks.k_nearest(q, c, q_ids, c_ids, k, own, cell_rows)
        assert sorted(zip(r, c_ids[i], d2)) == sorted(zip(row, c_ids[col], d[row, col]))


def test_distances_from_products_keep_their_promise():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(50, 64)), rng.normal(size=(40, 64))
    assert abs(blocks.sq_dists(x, y, 1e-9) - blocks.exact_sq_dists(x, y)).max() < 1e-11
    far = x * 1e6  # products of such numbers are too coarse
    assert (blocks.sq_dists(far, y, 1e-9) == blocks.exact_sq_dists(far, y)).all()
