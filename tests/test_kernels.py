"""Kernel operators over all rows and grids of classifiers against dense algebra."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import grid, kernelspace, partials


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(150, 5)) * 0.3, rng.normal(size=(150, 5)) * 0.3 + 1.0])
    y = (x.sum(axis=1) > 2.0).astype(float)
    rows = [(i, x[i].tolist(), float(y[i]), int(i % 3 + 1)) for i in range(300)]
    return spark.createDataFrame(rows, "key long, v array<double>, y double, fold int").repartition(5), x, y


def dense(x, sigma=1.0):
    return np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / sigma ** 2)


def test_products_sums_and_spectrum(points):
    df, x, _ = points
    k = kernelspace.KernelMatrix(df, "key", "v", kernelspace.gaussian(1.0), block_rows=64)
    K, n = dense(x), len(x)
    assert k.blocks > 3
    assert np.allclose(k.sums(), (n, K.sum(), (K * K).sum()))
    rng = np.random.default_rng(0)
    p = rng.normal(size=(n, 40))
    panel = df.sparkSession.createDataFrame([(i, p[i].tolist()) for i in range(n)], "key long, p array<double>")
    got = {r.key: r.w for r in k.times(panel).collect()}
    assert np.allclose(np.array([got[i] for i in range(n)]), K @ p)
    for centre in (True, False):
        H = np.eye(n) - (1 / n if centre else 0)
        want, vec = np.linalg.eigh(H @ K @ H)
        values, residual, scores = kernelspace.spectrum(k, 3, centre=centre, tol=1e-8)
        assert np.allclose(values, want[::-1][:3]) and residual.max() < 1e-6
        got = np.array([r.scores for r in scores.orderBy("key").collect()])
        for j in range(3):
            assert abs(abs(got[:, j] @ vec[:, -1 - j]) - np.sqrt(values[j])) < 1e-6


def test_a_spectrum_takes_row_sums_along(points, monkeypatch):
    df, x, _ = points
    d = dense(x)
    k = kernelspace.KernelMatrix(df, "key", "v", kernelspace.gaussian(1.0), block_rows=64)
    products, times = [], kernelspace.KernelMatrix.times
    monkeypatch.setattr(kernelspace.KernelMatrix, "times", lambda self, *a, **b: products.append(1) or times(self, *a, **b))
    values, residual, _ = kernelspace.spectrum(k, 2, tol=1e-5, tell=True)
    c = d - d.mean(axis=0) - d.mean(axis=1)[:, None] + d.mean()
    assert np.allclose(values, np.linalg.eigvalsh(c)[::-1][:2], rtol=1e-8) and residual.max() <= 1e-5 * values[0]
    made = len(products)
    assert np.allclose(k.sums(), (300.0, d.sum(), (d * d).sum()), rtol=1e-12)
    assert np.allclose([r["w"] for r in k.row_sums().orderBy("key").collect()], d.sum(axis=1)[:, None], rtol=1e-12)
    assert len(products) == made


def test_spectrum_of_a_matrix_of_low_rank(spark):
    rows = [(i, [float(i % 3)]) for i in range(90)]
    df = spark.createDataFrame(rows, "key string, v array<double>")
    k = kernelspace.KernelMatrix(df, "key", "v", kernelspace.gaussian(1.0))
    values, residual, _ = kernelspace.spectrum(k, 4, centre=False)
    want = np.linalg.eigvalsh(dense(np.array([[i % 3] for i in range(90)], dtype=float)))[::-1]
    assert np.allclose(values, want[:len(values)], atol=1e-8) and len(values) >= 3 and residual.max() < 1e-6


def test_degrees_of_freedom_lie_within_their_bars(points):
    df, x, _ = points
    k = kernelspace.KernelMatrix(df, "key", "v", kernelspace.gaussian(1.0))
    ev = np.linalg.eigvalsh(dense(x))
    lams = [0.1, 1.0, 30.0]
    exact = [float((ev / (ev + lam)).sum()) for lam in lams]
    for r, e in zip(kernelspace.effective_dof(k, lams, probes=40, seed=2), exact):
        assert r["low"] <= e <= r["high"] and r["high"] - r["low"] < 0.1 * e
    for r, e in zip(kernelspace.effective_dof(k, lams, probes=None, tol=1e-10), exact):
        assert abs(r["dof"] - e) < 1e-6 and r["low"] - 1e-7 <= e <= r["high"] + 1e-7


def test_array_sums_merge_by_a_tree(spark):
    df = spark.range(3000).repartition(70).selectExpr("cast(id as double) x")

    def reduce(batches):
        x = np.concatenate([b.column(0).to_numpy() for b in batches] or [np.zeros(0)])
        return {"big": np.concatenate([np.full(partials.CHUNK, x.sum()), [float(len(x))]]), "n": np.array([float(len(x))])}

    got = partials.array_sums(df, reduce)
    assert got["n"].tolist() == [3000.0] and got["big"].shape == (partials.CHUNK + 1,)
    assert got["big"][0] == got["big"][-2] == 2999 * 1500 and got["big"][-1] == 3000
    assert partials.array_sums(df.where("x < 0"), lambda batches: {}) == {}
    tall = np.random.default_rng(1).normal(size=(200, 4))
    rows = spark.createDataFrame([(r.tolist(),) for r in tall], "a array<double>").repartition(40)
    r = kernelspace.qr_factor(rows, ["a"])
    assert np.allclose(r.T @ r, tall.T @ tall) and np.allclose(r, np.triu(r))


def objective(phi, y, w, lam, loss, held):
    m = np.where(y > 0, 1.0, -1.0) * (phi @ w)
    return loss.value(m).mean() + 0.5 * lam * ((held * w) ** 2).sum()


@pytest.mark.parametrize("loss", [grid.Logistic, grid.SquaredHinge])
def test_all_fits_of_a_grid_reach_their_optimum(points, loss):
    df, x, y = points
    maps = [grid.Plain(5), grid.Fourier(5, 1.5, 60, seed=1)]
    fits = [grid.Fit(m, lam, f) for m in (0, 1) for lam in (0.01, 1.0) for f in (None, 2)]
    g = grid.Grid(df, maps, fits, loss, fold="fold")
    fold = np.arange(300) % 3 + 1
    rng = np.random.default_rng(0)
    for r in g.solve(1e-9):
        assert r["grad_norm"] < 1e-8
        phi, own = maps[r["fit"].features](x), fold != r["fit"].fold if r["fit"].fold else fold > 0
        held = maps[r["fit"].features].held
        here = objective(phi[own], y[own], r["weights"], r["fit"].lam, loss, held)
        assert abs(here - r["objective"]) < 1e-10 and r["n"] == own.sum()
        for _ in range(5):
            assert objective(phi[own], y[own], r["weights"] + 1e-3 * rng.normal(size=phi.shape[1]), r["fit"].lam, loss, held) > here
    g.close()


def test_cross_validation_tells_a_fit_from_a_broken_one(points):
    df, x, y = points
    found = grid.cross_validate(df, [grid.Plain(5), grid.Fourier(5, 1.5, 200)], [1e-3, 10.0], 3)
    always_no = min(y.mean(), 1 - y.mean())
    best = [r for r in found if r["is_best"]]
    assert len(best) == 1 and best[0]["error"] < always_no / 3 and best[0]["error"] == min(r["error"] for r in found)
    assert all(r["rows"] == 300 and len(r["shares"]) == 3 for r in found)
    fold = np.arange(300) % 3 + 1
    g = grid.Grid(df, [grid.Plain(5)], [grid.Fit(0, 1e-3, f) for f in (1, 2, 3)], fold="fold")
    w = [r["weights"] for r in g.solve()]
    wrong = [int(((np.hstack([np.ones((300, 1)), x]) @ w[f - 1] > 0) != (y > 0))[fold == f].sum()) for f in (1, 2, 3)]
    assert [e["wrong"] for e in g.errors(w)] == wrong
    assert [e["wrong"] for e in g.errors([-v for v in w])] == [100 - n for n in wrong]
    g.close()


def test_fourier_features_near_the_kernel(points):
    df, _, _ = points
    errors = [grid.feature_error(df, grid.Fourier(5, 1.0, size), key="key") for size in (64, 1024)]
    assert errors[1] < 0.04 and errors[1] < errors[0] / 2


def test_no_rows(spark):
    df = spark.createDataFrame([], "key long, v array<double>, y double")
    k = kernelspace.KernelMatrix(df, "key", "v", kernelspace.gaussian(1.0))
    assert k.n == 0 and k.sums() == (0.0, 0.0, 0.0)
    g = grid.Grid(df, [grid.Plain(3)], [grid.Fit(0, 1.0)])
    assert g.solve()[0]["weights"].tolist() == [0.0] * 4
    assert df.agg(F.count("*")).first()[0] == 0


def test_a_network_of_the_published_size_takes_a_step(spark):
    """784-1600-1600-10: 3.8 million weights; the step is that of one gradient over all rows."""
    from lodestar.operators import layers, nets

    rng = np.random.default_rng(0)
    x, y = rng.random((48, 784)), rng.integers(0, 10, 48)
    df = spark.createDataFrame([(x[i].tolist(), int(y[i])) for i in range(48)], "v array<double>, label int").repartition(3)
    net = layers.Layers([784, 1600, 1600, 10], "sigmoid", "cross_entropy")
    w = net.start(0)
    assert net.n_weights > 3_800_000
    hist = nets.train(df, net.n_weights, net.gradient, step=nets.Sgd(0.5), iters=1, vec="v", label="label", start=w, free=net.biases())
    g, loss = net.gradient(x, y, w)
    assert abs(hist[0]["loss"] - loss / 48) < 1e-9
    assert np.allclose(hist[-1]["weights"], w - 0.5 * g / 48, atol=1e-12)


def test_class_sums_without_pairs(points):
    from lodestar.operators import powersums, similarity

    df, x, y = points
    df = df.withColumn("label", F.col("y").cast("int"))
    d = x @ x.T
    for kind, param, k in (("linear", 0.0, d), ("vovk", 4, 1 + d + d ** 2 + d ** 3), ("vovk", 1, np.ones_like(d))):
        got = {(r.class_i, r.class_j): (r.ksum, r.pairs) for r in similarity.kernel_block_sum(df, df, kind, param, lid="key", rid="key").collect()}
        for i in (0, 1):
            for j in (0, 1):
                block = k[np.ix_(y == i, y == j)]
                assert got[i, j][1] == block.size and abs(got[i, j][0] - block.sum()) < 1e-8 * abs(k).sum()
        rows = {(r.test_id, r.label): r.ksum for r in similarity.kernel_row_sums(df, df, kind, param, tid="key", rid="key").collect()}
        assert max(abs(rows[i, c] - k[i, y == c].sum()) for i in range(300) for c in (0, 1)) < 1e-8 * abs(k).sum()
    old, powersums.MOST_NUMBERS = powersums.MOST_NUMBERS, 10
    try:  # too many numbers: the same sums over pairs of blocks
        got = {(r.class_i, r.class_j): r.ksum for r in similarity.kernel_block_sum(df, df, "vovk", 3, lid="key", rid="key", n_left=4).collect()}
    finally:
        powersums.MOST_NUMBERS = old
    k = 1 + d + d ** 2
    assert all(abs(got[i, j] - k[np.ix_(y == i, y == j)].sum()) < 1e-8 * abs(k).sum() for i in (0, 1) for j in (0, 1))
    k = dense(x)
    for r in powersums.gaussian_class_sums(df, 1.0).collect():
        block = k[np.ix_(y == r.class_i, y == r.class_j)]
        assert r.low <= block.sum() <= r.high and r.high - r.low < 0.2 * block.size and r.pairs == block.size


def test_kernel_sums_do_not_depend_on_tiles(spark):
    """Blocks of more rows than a tile has, with classes that are cut by tiles, on one and on two tables."""
    from lodestar.operators import blocks, similarity

    rng = np.random.default_rng(4)
    x, cls = rng.normal(size=(1400, 3)), rng.integers(0, 4, 1400)
    df = spark.createDataFrame([(i, r.tolist(), int(c)) for i, (r, c) in enumerate(zip(x, cls))], "vec_id long, v array<double>, label int")
    k = np.exp(-blocks.exact_sq_dists(x, x))
    for right in (df, df.select("*")):
        got = {(r.class_i, r.class_j): (r.ksum, r.pairs) for r in similarity.kernel_block_sum(df, right, "rbf", 1.0, n_left=1, n_right=1).collect()}
        for a in range(4):
            for b in range(4):
                part = k[cls == a][:, cls == b]
                assert got[a, b][0] == pytest.approx(part.sum(), rel=1e-9) and got[a, b][1] == part.size
        rows = {(r.test_id, r.label): r.ksum for r in similarity.kernel_row_sums(df, right, "rbf", 1.0).collect()}
        assert len(rows) == 5600
        assert all(rows[i, b] == pytest.approx(k[i, cls == b].sum(), rel=1e-9) for i in range(0, 1400, 13) for b in range(4))
    tiles = list(blocks.tiles(1400, 5000))
    assert sum((r.stop - r.start) * (c.stop - c.start) for r, c in tiles) == 1400 * 5000
