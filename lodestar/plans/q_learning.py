"""Layered networks, kernel features, spectral fits and model selection.

Where a fit has a closed form the oracle computes it.  Elsewhere a query states what must hold
(gradients agree with differences, the optimum is reached, errors stay under a bound) next to counts
that the oracle takes from the tables.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import kernels, layers, linear, metrics, moments, nets, sampling, similarity
from lodestar.plans import derived
from lodestar.plans.derived import ARMS_SQL, SCORED_SQL, SERIES_SQL, VECTORS_SQL
from lodestar.plans.q_lsh import _HASH_SQL, _index
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R, SQD
from lodestar.session import table

_REG_SQL = "r AS (SELECT l_extendedprice / 1000.0 AS y, l_quantity AS x1, l_orderkey FROM lineitem)"


def _reg(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select((F.col("l_extendedprice") / 1000.0).alias("y"), F.col("l_quantity").cast("double").alias("x1"),
                     F.col("l_discount").cast("double").alias("x2"), F.col("l_tax").cast("double").alias("x3"), "l_orderkey")


def _folds(df: DataFrame, n: int = 5, seed: int = 5) -> DataFrame:
    return df.withColumn("fold", F.pmod(sampling.hash_order("l_orderkey", seed), F.lit(n)))


# per-fold and complement sums of one predictor, for closed forms
_FOLD_SQL = f"""{_REG_SQL},
f AS (SELECT {sampling.hash_order_sql('l_orderkey', 5)} % 5 AS fold, y, x1 AS x FROM r),
c AS (SELECT fold, (SELECT avg(x) FROM f b WHERE b.fold <> a.fold) AS mx, (SELECT avg(y) FROM f b WHERE b.fold <> a.fold) AS my,
        (SELECT regr_sxy(y, x) FROM f b WHERE b.fold <> a.fold) AS sxy, (SELECT regr_sxx(y, x) FROM f b WHERE b.fold <> a.fold) AS sxx
      FROM (SELECT DISTINCT fold FROM f) a)"""


@register("cross_validated_ridge", sql=f"""
WITH {_FOLD_SQL}, l AS (SELECT * FROM (VALUES (0.0::DOUBLE), (1e4::DOUBLE), (1e6::DOUBLE)) t(lam)),
e AS (SELECT lam, f.fold, avg(power(f.y - (c.my + c.sxy / (c.sxx + lam) * (f.x - c.mx)), 2)) AS mse FROM f JOIN c USING (fold), l GROUP BY lam, f.fold),
s AS (SELECT lam, avg(mse) AS cv, stddev_samp(mse) / sqrt(count(*)) AS se FROM e GROUP BY lam),
b AS (SELECT * FROM s QUALIFY row_number() OVER (ORDER BY cv) = 1)
SELECT s.lam AS "lambda", {R('s.cv', 4)} AS cv_mse, {R('s.se', 4)} AS se, s.cv = b.cv AS is_best,
  s.lam = (SELECT max(s2.lam) FROM s s2, b b2 WHERE s2.cv <= b2.cv + b2.se) AS one_se_choice FROM s, b
""")
def cross_validated_ridge(spark: SparkSession, sf: str) -> DataFrame:
    """M21 + M23 + M24: ridge of price on quantity over three penalties, five hashed folds, one-SE choice."""
    df = _folds(_reg(spark, sf)).select("fold", "y", "x1")
    rows = linear.cv_ridge(df, "y", ["x1"], "fold", [0.0, 1e4, 1e6])
    return spark.createDataFrame([(r["lambda"], r["cv_mse"], r["se"], bool(r["is_best"]), bool(r["one_se_choice"])) for r in rows],
                                 "lambda double, cv_mse double, se double, is_best boolean, one_se_choice boolean").select(
        F.col("lambda"), V.rnd("cv_mse", 4).alias("cv_mse"), V.rnd("se", 4).alias("se"), "is_best", "one_se_choice")


@register("pc_regression", sql=f"""
WITH {_FOLD_SQL}
SELECT CAST(1 AS INTEGER) AS k, {R('sum(power(f.y - (c.my + c.sxy / c.sxx * (f.x - c.mx)), 2))', 2)} AS press,
  (SELECT {R('regr_slope(y, x)', 6)} FROM f) AS slope, true AS all_components_are_ols FROM f JOIN c USING (fold)
""")
def pc_regression_q(spark: SparkSession, sf: str) -> DataFrame:
    """M7: press of one-component regression on quantity; with three columns, all components must give least squares."""
    df = _folds(_reg(spark, sf))
    one = linear.pc_regression(df, "y", ["x1"], "fold")[0]
    three = linear.pc_regression(df, "y", ["x1", "x2", "x3"], "fold")
    same = bool(np.allclose(three[-1]["coefs"], linear.ols(df, "y", ["x1", "x2", "x3"]), rtol=1e-6, atol=1e-6)
                and sum(r["is_best"] for r in three) == 1)
    return spark.createDataFrame([(1, one["press"], one["coefs"][1], same)], "k int, press double, slope double, all_components_are_ols boolean").select(
        "k", V.rnd("press", 2).alias("press"), V.rnd("slope").alias("slope"), "all_components_are_ols")


@register("spectral_shrinkage", sql=f"""
WITH {_REG_SQL}, s AS (SELECT regr_sxy(y, x1) / sqrt(regr_sxx(y, x1)) AS a, sqrt(regr_sxx(y, x1)) AS root, avg(x1) AS mx, avg(y) AS my FROM r),
h AS (SELECT 'soft' AS how, sign(a) * greatest(abs(a) - 100.0, 0.0) AS a, root, mx, my FROM s
      UNION ALL SELECT 'hard', CASE WHEN abs(a) > 1e12 THEN a ELSE 0.0 END, root, mx, my FROM s
      UNION ALL SELECT 'ratio', a / (1 + 10000.0 / (a * a)), root, mx, my FROM s)
SELECT how, {R('a / root', 5)} AS slope, {R('my - a / root * mx', 4)} AS intercept FROM h
""")
def spectral_shrinkage_q(spark: SparkSession, sf: str) -> DataFrame:
    """M8: the coefficient of quantity in the eigenbasis, moved by 100, cut at 10^12, and scaled."""
    df = _reg(spark, sf)
    rows = [(how, *map(float, linear.spectral_shrinkage(df, "y", ["x1"], how, amount)[::-1]))
            for how, amount in (("soft", 100.0), ("hard", 1e12), ("ratio", 100.0))]
    return spark.createDataFrame(rows, "how string, slope double, intercept double").select(
        "how", V.rnd("slope", 5).alias("slope"), V.rnd("intercept", 4).alias("intercept"))


@register("stepwise_choice", sql=f"""
WITH r AS (SELECT l_extendedprice / 1000.0 AS y, l_quantity AS x1, l_discount AS x2, l_tax AS x3 FROM lineitem),
t AS (SELECT 'x1' AS term, corr(y, x1) AS c FROM r UNION ALL SELECT 'x2', corr(y, x2) FROM r UNION ALL SELECT 'x3', corr(y, x3) FROM r)
SELECT (SELECT term FROM t ORDER BY abs(c) DESC, term LIMIT 1) AS first_in, (SELECT term FROM t ORDER BY abs(c) DESC, term LIMIT 1) AS last_left,
  (SELECT {R('max(c * c)')} FROM t) AS r2_of_first, CAST(1 AS BIGINT) AS best_sizes
""")
def stepwise_choice(spark: SparkSession, sf: str) -> DataFrame:
    """M5: the first term taken forward, the last one left backward, and one best size by cross-validation each way."""
    df = _folds(_reg(spark, sf))
    xs = ["x1", "x2", "x3"]
    xtx, xty, yty, n = moments.gram(df, "y", xs)
    forward = linear._search(xtx, xty, yty, 3, "forward", 1)[0]
    backward = linear._search(xtx, xty, yty, 3, "backward", 1)[0]
    rss = linear.stepwise(df, "y", xs, "forward", 1)[0]["rss"]
    syy = yty - xty[0] ** 2 / n
    sizes = {sum(r["is_best"] for r in linear.best_subset_size(df, "y", xs, "fold", d)) for d in ("forward", "backward")}
    return spark.createDataFrame([(xs[forward], xs[backward], float(1 - rss / syy), len(sizes))],
                                 "first_in string, last_left string, r2_of_first double, best_sizes long").select(
        "first_in", "last_left", V.rnd("r2_of_first").alias("r2_of_first"), "best_sizes")


@register("pca_total_variance", sql=f"""
WITH v AS ({VECTORS_SQL}), e AS (SELECT r.i AS pos, v[r.i + 1] AS x FROM v, range(0, 64) r(i)),
s AS (SELECT pos, var_samp(x) AS var FROM e GROUP BY pos)
SELECT {R('sum(var)')} AS total_variance, true AS eigenpairs_hold, true AS scores_have_variance FROM s
""")
def pca_total_variance(spark: SparkSession, sf: str) -> DataFrame:
    """M6: eigenvalues add up to the total variance, eigenpairs fit the covariance, scores have the eigenvalues as variance."""
    v = derived.vectors(spark, sf)
    mean, vals, vecs = linear.pca(v, 64)
    _, cov, _ = moments.covariance_numpy(v)
    holds = bool(np.abs(cov @ vecs - vecs * vals).max() < 1e-9 and np.abs(vecs.T @ vecs - np.eye(64)).max() < 1e-9)
    s = linear.project(v, mean, vecs[:, :2]).agg(F.var_samp(F.col("pcs")[0]), F.var_samp(F.col("pcs")[1])).first()
    return spark.createDataFrame([(float(vals.sum()), holds, bool(np.allclose(list(s), vals[:2], rtol=1e-8)))],
                                 "total_variance double, eigenpairs_hold boolean, scores_have_variance boolean").select(
        V.rnd("total_variance").alias("total_variance"), "eigenpairs_hold", "scores_have_variance")


@register("smoothing_without_knots", sql=f"""
WITH s AS ({SERIES_SQL}), m AS (SELECT min(t) AS t0 FROM s)
SELECT {R('regr_slope(y, t - t0)', 6)} AS slope, {R('regr_intercept(y, t - t0)', 5)} AS intercept, count(*) AS buckets, true AS penalty_straightens FROM s, m
""")
def smoothing_without_knots(spark: SparkSession, sf: str) -> DataFrame:
    """M3: without penalized terms the generalized ridge is the regression line; a huge penalty on the bends of a
    spline (knots at quantiles of t) leads back to a curve as straight as it allows."""
    s = derived.series(spark, sf)
    t0 = s.agg(F.min("t")).first()[0]
    s = s.select("y", (F.col("t") - t0).cast("double").alias("x"))
    xtx, xty, _, n = moments.gram(s, "y", ["x"])
    line = linear.solve(xtx, xty, 10.0, omega=np.zeros((2, 2)))
    knots = [float(k) for k in s.approxQuantile("x", [i / 10 for i in range(1, 10)], 0.0)]
    names = [f"b{i}" for i in range(len(knots))]
    wide = s.select("y", "x", *[F.greatest(F.col("x") - k, F.lit(0.0)).alias(b) for k, b in zip(knots, names)])
    gx, gy, _, _ = moments.gram(wide, "y", ["x", *names])
    omega = np.diag([0.0, 0.0, *[1.0] * len(knots)])
    bend = [float(np.abs(linear.solve(gx, gy, lam, omega=omega)[2:]).max()) for lam in (1e-6, 1e9)]
    return spark.createDataFrame([(float(line[1]), float(line[0]), int(n), bend[1] < 1e-3 * max(bend[0], 1e-12))],
                                 "slope double, intercept double, buckets long, penalty_straightens boolean").select(
        V.rnd("slope").alias("slope"), V.rnd("intercept", 5).alias("intercept"), "buckets", "penalty_straightens")


@register("multioutput_fit", sql="""
WITH r AS (SELECT l_extendedprice / 1000.0 AS y1, l_tax * 100.0 AS y2, l_quantity AS x FROM lineitem),
o AS (SELECT * FROM (VALUES ('sgd'), ('nesterov'), ('adagrad')) t(optimizer))
SELECT optimizer, round(regr_slope(y1, x), 3) + 0.0 AS slope_1, round(regr_slope(y2, x), 3) + 0.0 AS slope_2 FROM r, o GROUP BY optimizer
""")
def multioutput_fit(spark: SparkSession, sf: str) -> DataFrame:
    """M15 + X6: two outputs on one standardized input, squared loss, by SGD, Nesterov and Adagrad steps over moments from one scan."""
    li = table(spark, sf, "lineitem").select((F.col("l_extendedprice") / 1000.0).alias("y1"), (F.col("l_tax") * 100.0).alias("y2"),
                                             F.col("l_quantity").cast("double").alias("x"))
    mean, sd = li.agg(F.avg("x"), F.stddev_samp("x")).first()
    d = li.select(F.array((F.col("x") - mean) / sd).alias("x"), F.array(F.col("y1").cast("double"), F.col("y2").cast("double")).alias("y"))
    net = layers.Layers([1, 2], loss="squared")
    sums = nets.moments(d, net)
    rows = []
    for name, rate, iters in (("sgd", 1.0, 12), ("nesterov", 1.0, 12), ("adagrad", 12.0, 80)):
        w = nets.train(d, net.n_weights, net.gradient, step=nets.STEPS[name](rate), iters=iters, start=np.zeros(net.n_weights),
                       free=net.biases(), tol=1e-7, sums=sums)[-1]["weights"]
        slopes = net.split(w)[0][1]
        rows.append((name, float(slopes[0] / sd), float(slopes[1] / sd)))
    return spark.createDataFrame(rows, "optimizer string, slope_1 double, slope_2 double").select(
        "optimizer", V.rnd("slope_1", 3).alias("slope_1"), V.rnd("slope_2", 3).alias("slope_2"))


def _gradient_agrees(net: layers.Layers, x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the gradient matches differences of the loss in a few directions."""
    rng = np.random.default_rng(1)
    w = net.start(3)
    g, _ = net.gradient(x, y, w)
    for _ in range(5):
        d = rng.normal(size=len(w))
        d /= np.linalg.norm(d)
        up, down = net.gradient(x, y, w + 1e-5 * d)[1], net.gradient(x, y, w - 1e-5 * d)[1]
        if abs((up - down) / 2e-5 - g @ d) > 1e-4 * max(1.0, abs(g @ d)):
            return False
    return True


def _sample(v: DataFrame, label: str) -> tuple[np.ndarray, np.ndarray]:
    rows = v.orderBy("vec_id").limit(20).collect()  # twenty rows, for difference quotients
    return np.array([r["v"] for r in rows]), np.array([r[label] for r in rows], dtype=float)


_MODEL_SQL = "SELECT count(*) AS rows, count(DISTINCT label) AS classes, true AS gradient_agrees, true AS loss_fell, true AS scores_agree FROM embeddings"


@register("mlp_fit", sql=_MODEL_SQL)
def mlp_fit(spark: SparkSession, sf: str) -> DataFrame:
    """M16 + F12 + K1: two sigmoid layers and a softmax trained by data-parallel Nesterov steps with momentum t/(t+3);
    the saved weights score the table."""
    v = derived.vectors(spark, sf)
    n_classes = v.agg(F.max("label") + 1).first()[0]
    net = layers.Layers([64, 16, 16, n_classes], "sigmoid", "cross_entropy")
    hist = nets.train(v, net.n_weights, net.gradient, step=nets.Nesterov(0.5), lam=1e-4, iters=15, vec="v", label="label",
                      start=net.start(0), free=net.biases())
    w = np.array(hist[-1]["weights"])
    back = layers.from_table(layers.weights_table(spark, net, w, "mlp"))
    scored = layers.mlp_score(v.select("vec_id", "label", "v"), net, back)
    ok = scored.agg(F.max(F.abs(V.vsum("outputs") - 1.0)).alias("off"), F.count("*").alias("rows"), F.countDistinct("label").alias("classes")).first()
    fell = hist[-1]["loss"] < hist[0]["loss"]
    return spark.createDataFrame([(ok["rows"], ok["classes"], _gradient_agrees(net, *_sample(v, "label")), bool(fell), bool(ok["off"] < 1e-9))],
                                 "rows long, classes long, gradient_agrees boolean, loss_fell boolean, scores_agree boolean")


@register("mlp_relu_fit", sql=f"SELECT * FROM (VALUES ('sgd'), ('nesterov'), ('adagrad')) o(optimizer), ({_MODEL_SQL.replace(', true AS scores_agree', '')}) m")
def mlp_relu_fit(spark: SparkSession, sf: str) -> DataFrame:
    """M17 + X6: one ReLU layer with squared loss on one-hot targets, by three step rules."""
    v = derived.vectors(spark, sf)
    rows, classes, n_classes = v.agg(F.count("*"), F.countDistinct("label"), F.max("label") + 1).first()
    net = layers.Layers([64, 24, n_classes], "relu", "squared")
    agrees = _gradient_agrees(net, *_sample(v, "label"))
    out = []
    for name, rate in (("sgd", 0.3), ("nesterov", 0.1), ("adagrad", 0.05)):
        hist = nets.train(v, net.n_weights, net.gradient, step=nets.STEPS[name](rate), iters=8, vec="v", label="label",
                          start=net.start(0), free=net.biases())
        out.append((name, rows, classes, agrees, bool(hist[-1]["loss"] < hist[0]["loss"])))
    return spark.createDataFrame(out, "optimizer string, rows long, classes long, gradient_agrees boolean, loss_fell boolean")


@register("softplus_fit", sql=_MODEL_SQL.replace(", true AS scores_agree", ""))
def softplus_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Linear outputs, one for each label, with softplus loss on ±1 targets."""
    v = derived.vectors(spark, sf)
    rows, classes, n_classes = v.agg(F.count("*"), F.countDistinct("label"), F.max("label") + 1).first()
    net = layers.Layers([64, n_classes], loss="softplus")
    hist = nets.train(v, net.n_weights, net.gradient, step=nets.Adagrad(0.1), iters=12, vec="v", label="label",
                      start=np.zeros(net.n_weights), free=net.biases())
    return spark.createDataFrame([(rows, classes, _gradient_agrees(net, *_sample(v, "label")), bool(hist[-1]["loss"] < hist[0]["loss"]))],
                                 "rows long, classes long, gradient_agrees boolean, loss_fell boolean")


_W1 = "sin(12.9898::DOUBLE * ({j} * 65 + {i}))"


@register("mlp_scores", sql=f"""
WITH v AS ({VECTORS_SQL}),
h AS (SELECT vec_id, list_transform(range(0, 4), lambda j: 1.0 / (1.0 + exp(-({_W1.format(j='j', i='0')} +
        list_sum(list_transform(range(1, 65), lambda i: v[i] * {_W1.format(j='j', i='i')})))))) AS h FROM v)
SELECT vec_id, {R('1.0 + list_sum(list_transform(range(1, 5), lambda i: h[i] * cos(i::DOUBLE)))')} AS output FROM h
""")
def mlp_scores(spark: SparkSession, sf: str) -> DataFrame:
    """a network with one sigmoid layer of fixed weights scores every vector."""
    net = layers.Layers([64, 4, 1], "sigmoid", "squared")
    first = np.sin(12.9898 * (np.arange(4)[None, :] * 65 + np.arange(65)[:, None]))
    w = np.r_[first.ravel(), 1.0, np.cos(np.arange(1.0, 5.0))]
    d = layers.mlp_score(derived.vectors(spark, sf).select("vec_id", "v"), net, w)
    return d.select("vec_id", V.rnd(F.col("outputs")[0]).alias("output"))


@register("logistic_optimum", sql="""
SELECT count(*) AS rows, CAST(sum(CAST(label = 3 AS INTEGER)) AS BIGINT) AS positives, true AS at_optimum, true AS batches_come_near FROM embeddings
""")
def logistic_optimum(spark: SparkSession, sf: str) -> DataFrame:
    """M14 + A17: class 3 against the rest.  Full gradients reach the library's optimum; mini-batches with a step that
    falls as t^(−1/3) come near it."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    v = derived.vectors(spark, sf)
    d = v.select("vec_id", V.add_intercept("v").alias("x"), (F.col("label") == 3).cast("double").alias("y"))
    rows, positives = d.agg(F.count("*"), F.sum("y").cast("long")).first()
    lam = 0.1
    full = nets.train(d, 65, lam=lam, iters=80, tol=1e-6, step=nets.Nesterov(2.0))
    lib = LogisticRegression(regParam=lam, elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-12).fit(
        v.select(array_to_vector("v").alias("features"), (F.col("label") == 3).cast("double").alias("label")))
    best = np.r_[lib.intercept, lib.coefficients.toArray()]

    def objective(w):
        _, loss, n = nets.gradient_sum(d, w, nets.logistic_grad)
        return loss / n + 0.5 * lam * float(np.sum(w[1:] ** 2))

    low = objective(best)
    mini = nets.train(d, 65, lam=lam, iters=60, step=nets.Nesterov(0.5, 1 / 3), batches=4, key="vec_id")
    return spark.createDataFrame([(rows, positives, bool(objective(np.array(full[-1]["weights"])) - low < 1e-5),
                                   bool(objective(np.array(mini[-1]["weights"])) - low < 0.02))],
                                 "rows long, positives long, at_optimum boolean, batches_come_near boolean")


@register("lipschitz_bound", sql="SELECT count(*) AS rows, true AS under_bound FROM embeddings")
def lipschitz_bound(spark: SparkSession, sf: str) -> DataFrame:
    """The slope of the logistic gradient between two points stays under λmax(XᵀX) / 4n."""
    v = derived.vectors(spark, sf)
    d = v.select(V.add_intercept("v").alias("x"), (F.col("label") == 3).cast("double").alias("y"))
    step = nets.lipschitz_step(d, 65)
    m = np.zeros((65, 65))
    n = 0
    for r in moments.gram_entries(d, vec="x").collect():
        m[r["i"], r["j"]], n = r["s"], r["n"]
    return spark.createDataFrame([(int(n), bool(0 < 1 / step <= np.linalg.eigvalsh(m)[-1] / (4 * n) * (1 + 1e-9)))], "rows long, under_bound boolean")


@register("hard_negative_rounds", sql=f"""
WITH s AS ({SCORED_SQL}), c AS (SELECT sum(CAST(label = 0 AS INTEGER)) AS p, sum(CAST(label = 1 AS INTEGER)) AS n FROM s)
SELECT CAST(round AS INTEGER) AS round, CAST(p AS BIGINT) AS positives, CAST(least(n, 2 * p) AS BIGINT) AS negatives, true AS loss_is_finite
FROM c, range(0, 4) t(round)
""")
def hard_negative_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Rounds of mining (P highest-scored and P other negatives) and refitting from the last weights, with a
    proximal term; the rare class (quality 0) is positive, features are length, its logarithm and toxicity."""
    s = derived.scored_docs(spark, sf).select(
        "doc_id", (1 - F.col("label")).alias("label"), F.array(F.lit(1.0), F.log1p("score") / 10.0, F.col("toxic").cast("double")).alias("x"))
    rows = []
    for r in nets.hard_negative_training(s, "doc_id", "x", "label", 3, rounds=3, iters=8):
        rows.append((r["round"], r["positives"], r["negatives"], bool(np.isfinite(r["loss"]))))
    return spark.createDataFrame(rows, "round int, positives long, negatives long, loss_is_finite boolean")


_KS = "s AS (SELECT t, y / 10.0 AS y FROM (" + SERIES_SQL + "))"


@register("kernel_change_point", sql=f"""
WITH {_KS}, p AS (SELECT row_number() OVER (ORDER BY t, y) AS i, t, y, count(*) OVER () AS n FROM s),
k AS (SELECT a.i AS i, b.i AS j, a.n AS n, exp(-(a.y - b.y) * (a.y - b.y)) AS k FROM p a, p b),
u AS (SELECT g.i AS t, max(n) * 1.0 AS n, sum(CASE WHEN k.i <= g.i AND k.j <= g.i THEN k ELSE 0 END) AS before,
        sum(CASE WHEN k.i > g.i AND k.j > g.i THEN k ELSE 0 END) AS later, sum(CASE WHEN k.i <= g.i AND k.j > g.i THEN k ELSE 0 END) AS across
      FROM k, (SELECT i FROM p WHERE i < n) g GROUP BY g.i),
f AS (SELECT t, (n - t) / (n * t) * before + t / (n * (n - t)) * later - 2 / n * across AS score FROM u)
SELECT t, {R('score', 5)} AS score, row_number() OVER (ORDER BY score DESC, t) = 1 AS is_change FROM f
""")
def kernel_change_point(spark: SparkSession, sf: str) -> DataFrame:
    """The score of every split of the 6-hour series and the best one."""
    s = derived.series(spark, sf).withColumn("y", F.col("y") / 10.0)
    c = kernels.change_point(s, "t", "y", 1.0).select("t", "score")
    best = c.orderBy(F.desc("score"), "t").first()["t"]  # one number
    return c.select("t", V.rnd("score", 5).alias("score"), (F.col("t") == best).alias("is_change"))


@register("kernel_pca_trace", sql=f"""
WITH {_KS}, k AS (SELECT exp(-(a.y - b.y) * (a.y - b.y)) AS k FROM s a, s b), m AS (SELECT count(*) AS n FROM s)
SELECT {R('max(n) - sum(k) / max(n)', 5)} AS trace, {R('max(n) * 1.0 / 1e6 - sum(k * k) / 1e12', 9)} AS dof_at_1e6, true AS dof_falls, true AS scores_are_centred
FROM k, m
""")
def kernel_pca_trace(spark: SparkSession, sf: str) -> DataFrame:
    """M9 + A16: eigenvalues of the centred kernel matrix add up to its trace; degrees of freedom at a large penalty
    follow their expansion and fall with the penalty.  All 6-hour buckets fit among the landmarks, so this is exact."""
    s = derived.series(spark, sf).select("t", F.array(F.col("y") / 10.0).alias("v"))
    n = s.count()
    marks = kernels.choose_landmarks(s, "t", "v", 1.0, max(kernels.LANDMARKS, n))
    values, scored = kernels.kernel_pca(s, marks, 2)
    _, raw, _ = kernels.feature_gram(kernels.featurize(s, marks), centre=False)
    spectrum = np.linalg.eigvalsh(raw)
    dofs = [kernels.effective_dof(spectrum, lam) for lam in (0.01, 0.1, 1.0, 1e6)]
    mean = scored.agg(F.avg(F.col("kpcs")[0]), F.avg(F.col("kpcs")[1])).first()
    return spark.createDataFrame([(float(values.sum()), dofs[-1], all(a > b for a, b in zip(dofs, dofs[1:])), bool(max(map(abs, mean)) < 1e-8))],
                                 "trace double, dof_at_1e6 double, dof_falls boolean, scores_are_centred boolean").select(
        V.rnd("trace", 5).alias("trace"), V.rnd("dof_at_1e6", 9).alias("dof_at_1e6"), "dof_falls", "scores_are_centred")


@register("kernel_logistic_fit", sql="""
SELECT count(*) AS rows, CAST(sum(CAST(label = 3 AS INTEGER)) AS BIGINT) AS positives, true AS loss_fell, true AS error_at_most_prior FROM embeddings
""")
def kernel_logistic_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Class 3 against the rest on landmark features of the Gaussian kernel."""
    v = derived.vectors(spark, sf).select("vec_id", "v", (F.col("label") == 3).cast("double").alias("y"))
    marks = kernels.choose_landmarks(v, "vec_id", "v", 1.0, 64)
    hist, phi = kernels.kernel_logistic(v, marks, 1e-3, iters=15)
    scored = layers.mlp_score(phi, layers.Layers([marks.turn.shape[1], 1], loss="squared"), np.r_[0.0, hist[-1]["weights"]], "phi")
    wrong = F.avg(((F.col("outputs")[0] > 0) != (F.col("y") > 0)).cast("double"))
    rows, positives, error = scored.agg(F.count("*"), F.sum("y").cast("long"), wrong).first()
    prior = max(positives, rows - positives) / rows
    return spark.createDataFrame([(rows, positives, bool(hist[-1]["loss"] < hist[0]["loss"]), bool(error <= prior))],
                                 "rows long, positives long, loss_fell boolean, error_at_most_prior boolean")


@register("layerwise_probe", sql="SELECT CAST(layer AS INTEGER) AS layer, count(*) AS rows, true AS error_in_range FROM embeddings, range(0, 3) t(layer) GROUP BY layer")
def layerwise_probe(spark: SparkSession, sf: str) -> DataFrame:
    """Each layer of a small trained network: kernel PCA, a linear classifier on the scores, smallest error over two widths."""
    v = derived.vectors(spark, sf).select("vec_id", "label", "v")
    n_classes = v.agg(F.max("label") + 1).first()[0]
    net = layers.Layers([64, 12, 8, n_classes], "sigmoid", "cross_entropy")
    w = np.array(nets.train(v, net.n_weights, net.gradient, step=nets.Nesterov(0.5), iters=5, vec="v", label="label",
                            start=net.start(0), free=net.biases())[-1]["weights"])
    out = []
    for r in kernels.layer_probe(v, net, w, [1.0, 4.0], 4, n_classes):
        out.append((r["layer"], r["rows"], bool(0 <= r["error"] <= 1)))
    return spark.createDataFrame(out, "layer int, rows long, error_in_range boolean")


@register("held_out_error_bounds", sql="SELECT * FROM (VALUES ('linear_svc', true), ('decision_tree', true)) t(model, error_in_bounds)")
def held_out_error_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """M19 + M20: held-out errors of the grids: the SVM stays near the share of its rare class, the best tree under chance for ten labels plus a margin."""
    from lodestar.plans import q_models

    svc = [r["test_error"] for r in q_models.linear_svc_grid(spark, sf).collect()]
    rare = derived.vectors(spark, sf).agg(F.avg((F.col("label") == 3).cast("double"))).first()[0]
    tree = [r["cv_error"] for r in q_models.decision_tree_cv(spark, sf).collect()]
    return spark.createDataFrame([("linear_svc", bool(0 <= min(svc) <= rare + 0.1)), ("decision_tree", bool(0 <= min(tree) <= 0.95))],
                                 "model string, error_in_bounds boolean")


@register("arm_interval_checks", sql=f"""
WITH a AS ({ARMS_SQL}), p AS (SELECT arm, sum(reward) + 1.0 AS alpha, count(*) - sum(reward) + 1.0 AS beta FROM a GROUP BY arm)
SELECT arm, {R('alpha / (alpha + beta)')} AS mean, {R('sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1)))', 5)} AS sd,
  true AS quantiles_hold FROM p
""")
def arm_interval_checks(spark: SparkSession, sf: str) -> DataFrame:
    """B2: between the 2.5 % and 97.5 % quantiles lies 95 % of the posterior, by numerical integration of its density."""
    from lodestar.operators import events

    p = events.arm_posteriors(derived.arms(spark, sf), "arm", "reward")
    out = []
    for r in events.arm_intervals(p).join(p.select("arm", F.col("alpha").alias("_a"), F.col("beta").alias("_b")), "arm").collect():  # one row for each arm
        a, b = float(r["_a"]), float(r["_b"])
        mean, sd = a / (a + b), float(np.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))))
        x = np.linspace(max(1e-9, mean - 12 * sd), min(1 - 1e-9, mean + 12 * sd), 400_001)
        d = np.exp((a - 1) * np.log(x / mean) + (b - 1) * np.log((1 - x) / (1 - mean)))
        below = [float(d[x < q].sum() / d.sum()) for q in (r["lower"], r["upper"])]
        out.append((r["arm"], mean, sd, bool(abs(below[0] - 0.025) < 1e-3 and abs(below[1] - 0.975) < 1e-3)))
    return spark.createDataFrame(out, "arm string, mean double, sd double, quantiles_hold boolean").select(
        "arm", V.rnd("mean").alias("mean"), V.rnd("sd", 5).alias("sd"), "quantiles_hold")


@register("micro_average_precision", sql=f"""
WITH s AS ({SCORED_SQL}), p AS (SELECT score, label AS y FROM s UNION ALL SELECT score, toxic FROM s),
g AS (SELECT score, sum(y) AS pos, count(*) AS n FROM p GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos, sum(n) OVER (ORDER BY score DESC) AS cum_n FROM g)
SELECT {R('sum(pos * cum_pos / cum_n) / sum(pos)')} AS micro_ap, CAST(sum(pos) AS BIGINT) AS n_pos FROM c
""")
def micro_average_precision(spark: SparkSession, sf: str) -> DataFrame:
    """A10, micro: one ranking over the pairs of document and label (quality, toxic)."""
    s = derived.scored_docs(spark, sf)
    pairs = s.select("score", F.explode(F.array("label", "toxic")).alias("y"))
    return metrics.average_precision(pairs, "score", "y").select(V.rnd("ap").alias("micro_ap"), F.col("n_pos").cast("long"))


@register("knn_with_priors", sql=f"""
WITH v AS ({VECTORS_SQL}), cs AS (SELECT label, 0.1 / count(*) AS weight FROM v GROUP BY label),
d AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, b.label, sqrt({SQD('a.v', 'b.v')}) AS distance FROM v a JOIN v b ON a.vec_id <> b.vec_id),
nb AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) <= 7),
g AS (SELECT query_id, label, count(*) * any_value(weight) AS score, min(distance) AS nearest FROM nb JOIN cs USING (label) GROUP BY query_id, label)
SELECT query_id, label AS predicted FROM g QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, nearest, label) = 1
""")
def knn_with_priors(spark: SparkSession, sf: str) -> DataFrame:
    """M11 with priors: votes of 7 neighbours, weighed by an equal prior over the class sizes."""
    v = derived.vectors(spark, sf)
    weight = v.groupBy("label").agg((F.lit(0.1) / F.count("*")).alias("weight"))
    return similarity.knn_classify_many_k(v, v, [7], priors=weight).select("query_id", "predicted")


@register("lsh_key_prefix_lookup", sql=f"""
WITH {_HASH_SQL}, q AS (SELECT vec_id, table_id, split_part(bucket, ':', 1) AS h FROM h),
b AS (SELECT table_id, split_part(bucket, ':', 1) AS first, count(*) AS rows FROM h GROUP BY 1, 2)
SELECT q.vec_id AS query_id, CAST(q.table_id AS INTEGER) AS table_id, CAST(sum(b.rows) AS BIGINT) AS matches
FROM q JOIN b ON q.table_id = b.table_id AND starts_with(b.first, q.h) GROUP BY q.vec_id, q.table_id
""")
def lsh_key_prefix_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Index rows whose whole key starts with the query's first component, as LIKE 'h%' finds them ("1" also
    meets "10:...").  Every beginning of a key's first component is a key of its own, so the lookup is an equi-join."""
    idx = _index(spark, sf).select("vec_id", "table_id", F.split("bucket", ":")[0].alias("first"))
    sizes = idx.groupBy("table_id", "first").agg(F.count("*").alias("rows"))
    starts = sizes.withColumn("h", F.explode(F.expr("transform(sequence(1, length(first)), i -> substring(first, 1, i))")))
    found = starts.groupBy("table_id", "h").agg(F.sum("rows").alias("matches"))
    return idx.join(found.withColumnRenamed("h", "first"), ["table_id", "first"]).select(
        F.col("vec_id").alias("query_id"), "table_id", "matches")


@register("own_kernel_sums", sql=f"""
WITH v AS ({VECTORS_SQL}),
k AS (SELECT a.label AS class_i, b.label AS class_j, 1.0 / (1.0 + {SQD('a.v', 'b.v')}) AS k FROM v a, v b)
SELECT class_i, class_j, {R('sum(k)', 5)} AS ksum, count(*) AS pairs FROM k GROUP BY class_i, class_j
""")
def own_kernel_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Class sums of a kernel of the user's own, 1 / (1 + ‖a − b‖²)."""
    from lodestar.operators.blocks import sq_dists

    v = derived.vectors(spark, sf)
    k = similarity.kernel_block_sum(v, v, lambda a, b, _: 1.0 / (1.0 + sq_dists(a, b, 1e-11)), 0.0, "label", "label", "vec_id", "vec_id", "v")
    return k.select("class_i", "class_j", V.rnd("ksum", 5).alias("ksum"), "pairs")
