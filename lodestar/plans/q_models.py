"""Model and model-selection queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import linear, nets, sampling
from lodestar.plans import derived
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R
from lodestar.session import table


def _reg(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select((F.col("l_extendedprice") / 1000.0).alias("y"), F.col("l_quantity").alias("x1"),
                     F.col("l_discount").alias("x2"), F.col("l_tax").alias("x3"), "l_orderkey")


_REG_SQL = "r AS (SELECT l_extendedprice / 1000.0 AS y, l_quantity AS x1 FROM lineitem)"


@register("ols_fit", sql=f"""
WITH {_REG_SQL}
SELECT 'intercept' AS term, {R('regr_intercept(y, x1)', 4)} AS coef FROM r
UNION ALL SELECT 'x1', {R('regr_slope(y, x1)', 4)} FROM r
""")
def ols_fit(spark: SparkSession, sf: str) -> DataFrame:
    """M1: least squares of price/1000 on quantity from one Gram pass."""
    b = linear.ols(_reg(spark, sf), "y", ["x1"])
    return spark.createDataFrame([("intercept", float(b[0])), ("x1", float(b[1]))], "term string, coef double").select(
        "term", V.rnd("coef", 4).alias("coef"))


_LAMS = [0.0, 1e5, 1e7]


@register("ridge_path", sql=f"""
WITH {_REG_SQL}, s AS (SELECT regr_sxy(y, x1) AS sxy, regr_sxx(y, x1) AS sxx, avg(x1) AS mx, avg(y) AS my, var_samp(x1) AS vx FROM r),
l AS (SELECT * FROM (VALUES (0.0::DOUBLE), (1e5::DOUBLE), (1e7::DOUBLE)) t(lam))
SELECT lam AS lambda, {R('my - sxy / (sxx + lam * vx) * mx', 4)} AS intercept, {R('sxy / (sxx + lam * vx)', 4)} AS slope FROM s, l
""")
def ridge_path_q(spark: SparkSession, sf: str) -> DataFrame:
    """M2: ridge path with an unpenalized intercept, λ on the standardized column (one pass for all λ)."""
    path = linear.ridge_path(_reg(spark, sf), "y", ["x1"], _LAMS)
    return spark.createDataFrame([(lam, float(b[0]), float(b[1])) for lam, b in path],
                                 "lambda double, intercept double, slope double").select(
        "lambda", V.rnd("intercept", 4).alias("intercept"), V.rnd("slope", 4).alias("slope"))


@register("loo_gcv", sql=f"""
WITH {_REG_SQL}, s AS (SELECT regr_sxy(y, x1) AS sxy, regr_sxx(y, x1) AS sxx, avg(x1) AS mx, avg(y) AS my, count(*) AS n FROM r),
c AS (SELECT sxy / (sxx + 1e5) AS b, my - sxy / (sxx + 1e5) * mx AS a, 1 + sxx / (sxx + 1e5) AS tr, * FROM s),
e AS (SELECT r.y - (c.a + c.b * r.x1) AS e, 1.0 / c.n + (r.x1 - c.mx) * (r.x1 - c.mx) / (c.sxx + 1e5) AS h, c.tr, c.n FROM r, c)
SELECT {R('avg((e / (1 - h)) * (e / (1 - h)))')} AS loo_mse, {R('avg(e * e) / ((1 - max(tr) / max(n)) * (1 - max(tr) / max(n)))')} AS gcv,
  {R('max(tr)')} AS dof FROM e
""")
def loo_gcv_q(spark: SparkSession, sf: str) -> DataFrame:
    """M4: leave-one-out error from leverages and GCV (squared denominator) for ridge at λ = 1e5."""
    r = linear.loo_and_gcv(_reg(spark, sf), "y", ["x1"], 1e5)
    return r.select(V.rnd("loo_mse").alias("loo_mse"), V.rnd("gcv").alias("gcv"), V.rnd("dof").alias("dof"))


@register("cv_ridge_one_se")
def cv_ridge_one_se(spark: SparkSession, sf: str) -> DataFrame:
    """M21 + M24: 10-fold CV error per λ from fold Grams, best λ and the one-SE choice; rows-only check."""
    df = _reg(spark, sf).withColumn("fold", F.pmod(sampling.hash_order("l_orderkey", 5), F.lit(10)))
    rows = linear.cv_ridge(df, "y", ["x1", "x2", "x3"], "fold", [0.0, 1.0, 10.0, 100.0, 1e3, 1e4, 1e5])
    return spark.createDataFrame([(r["lambda"], r["cv_mse"], r["se"], r["is_best"], r["one_se_choice"]) for r in rows],
                                 "lambda double, cv_mse double, se double, is_best boolean, one_se_choice boolean")


@register("stepwise_forward")
def stepwise_forward(spark: SparkSession, sf: str) -> DataFrame:
    """M5: forward selection over five terms (RSS and GCV per step); rows-only check."""
    df = _reg(spark, sf).withColumn("x1sq", F.col("x1") ** 2).withColumn("x1x2", F.col("x1") * F.col("x2"))
    steps = linear.stepwise(df, "y", ["x1", "x2", "x3", "x1sq", "x1x2"], "forward")
    return spark.createDataFrame([(s["step"], s["term"], s["terms"], s["rss"], s["gcv"]) for s in steps],
                                 "step int, term string, terms int, rss double, gcv double")


@register("pca_components")
def pca_components(spark: SparkSession, sf: str) -> DataFrame:
    """M6: five leading eigenpairs of the embedding covariance; rows-only check (library cross-check in tests)."""
    mean, vals, vecs = linear.pca(derived.vectors(spark, sf), 5)
    return spark.createDataFrame([(j + 1, float(vals[j]), float(np.abs(vecs[:, j]).max())) for j in range(len(vals))],
                                 "component int, eigenvalue double, max_loading double")


@register("pca_scores")
def pca_scores(spark: SparkSession, sf: str) -> DataFrame:
    """M6 projection: each embedding's scores on the two leading components; rows-only check."""
    v = derived.vectors(spark, sf)
    mean, vals, vecs = linear.pca(v, 2)
    p = linear.project(v, mean, vecs)
    return p.select("vec_id", F.col("pcs")[0].alias("pc1"), F.col("pcs")[1].alias("pc2"))


def _binary(spark: SparkSession, sf: str) -> DataFrame:
    v = derived.vectors(spark, sf)
    return v.select("vec_id", V.add_intercept("v").alias("x"), (F.col("label") == 3).cast("double").alias("y"))


@register("logistic_gd")
def logistic_gd(spark: SparkSession, sf: str) -> DataFrame:
    """Logistic regression (class 3 vs rest) by distributed gradient sums + Nesterov; loss per iteration."""
    hist = nets.train(_binary(spark, sf), 65, nets.logistic_grad, rate=2.0, lam=1e-3, iters=40)
    return spark.createDataFrame([(h["iteration"], h["loss"], h["grad_norm"]) for h in hist],
                                 "iteration int, loss double, grad_norm double")


@register("lipschitz_step")
def lipschitz_step_q(spark: SparkSession, sf: str) -> DataFrame:
    """Step size 1/L from gradients at two random points; rows-only check."""
    s = nets.lipschitz_step(_binary(spark, sf), 65)
    return spark.createDataFrame([(s,)], "step double")


@register("linear_svc_grid")
def linear_svc_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Linear SVM (class 3 vs rest) over a regularisation grid, train and test error; rows-only check."""
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import array_to_vector

    v = derived.vectors(spark, sf)
    d = sampling.split_train_test(v, "vec_id", 0.3).select(
        array_to_vector("v").alias("features"), (F.col("label") == 3).cast("double").alias("y"), "split").cache()
    rows = []
    for c in [0.001, 0.01, 0.1, 1.0]:
        m = LinearSVC(featuresCol="features", labelCol="y", regParam=c, maxIter=50).fit(d.where("split = 'train'"))
        e = m.transform(d).groupBy("split").agg(F.avg((F.col("prediction") != F.col("y")).cast("double")).alias("err"))
        errs = {r["split"]: r["err"] for r in e.collect()}
        rows.append((c, errs.get("train"), errs.get("test")))
    d.unpersist()
    return spark.createDataFrame(rows, "reg_param double, train_error double, test_error double")


@register("decision_tree_cv")
def decision_tree_cv(spark: SparkSession, sf: str) -> DataFrame:
    """M20 + M24: decision tree over a min-information-gain grid, 5-fold CV error on held-out folds."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import array_to_vector

    v = derived.vectors(spark, sf)
    d = sampling.assign_folds(v, 5, ["vec_id"], random_key="vec_id", seed=11).select(
        array_to_vector("v").alias("features"), F.col("label").cast("double").alias("y"), "fold").cache()
    rows = []
    for g in [0.0, 0.01, 0.05]:
        errs = []
        for f in range(1, 6):
            m = DecisionTreeClassifier(featuresCol="features", labelCol="y", minInfoGain=g, maxDepth=6).fit(d.where(F.col("fold") != f))
            e = m.transform(d.where(F.col("fold") == f)).agg(F.avg((F.col("prediction") != F.col("y")).cast("double"))).first()[0]
            errs.append(e)
        rows.append((g, float(np.mean(errs)), float(np.std(errs, ddof=1) / np.sqrt(len(errs)))))
    d.unpersist()
    return spark.createDataFrame(rows, "min_info_gain double, cv_error double, se double")


@register("standardize_columns", sql=f"""
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_discount) AS md, max(l_discount) - min(l_discount) AS rd FROM lineitem)
SELECT l_orderkey, l_linenumber, {R('(l_quantity - mq) / sq')} AS quantity_sd, {R('(l_discount - md) / rd')} AS discount_range FROM lineitem, s
""")
def standardize_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity by (x − mean)/sd and discount by (x − mean)/(max − min); statistics from one aggregate."""
    from lodestar.operators.moments import standardize

    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    a = standardize(li, ["l_quantity"], "sd")
    a = standardize(a, ["l_discount"], "range", measured_on=li)
    return a.select("l_orderkey", "l_linenumber", V.rnd("l_quantity").alias("quantity_sd"), V.rnd("l_discount").alias("discount_range"))


@register("standardize_by_scale", sql=f"""
WITH s AS (SELECT avg(l_quantity) AS mq, var_samp(l_quantity) AS vq, avg(l_tax) AS mt FROM lineitem)
SELECT l_orderkey, l_linenumber, {R('(l_quantity - mq) / vq')} AS quantity_var, {R('l_tax / mt')} AS tax_mean FROM lineitem, s
""")
def standardize_by_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity by (x − mean)/variance and tax by x/mean."""
    from lodestar.operators.moments import standardize

    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    d = standardize(standardize(li, ["l_quantity"], "var"), ["l_tax"], "mean", measured_on=li)
    return d.select("l_orderkey", "l_linenumber", V.rnd("l_quantity").alias("quantity_var"), V.rnd("l_tax").alias("tax_mean"))


@register("smoothing_spline")
def smoothing_spline(spark: SparkSession, sf: str) -> DataFrame:
    """M3: generalized ridge (XᵀX + λΩ)⁻¹Xᵀy on the hinge basis of the 6-hour series with a
    second-difference penalty on the hinge coefficients; fitted curve per bucket; rows-only check."""
    from lodestar.functions.vectors import hinge_basis
    from lodestar.operators.moments import gram

    s = derived.series(spark, sf)
    t0 = s.agg(F.min("t")).first()[0]  # one scalar
    cuts = s.select((F.col("t") - t0).cast("double").alias("x")).approxQuantile("x", [i / 20 for i in range(1, 20)], 0.0)
    knots = sorted(set(cuts))
    b = s.select("t", "y", hinge_basis(F.col("t") - F.lit(t0), knots).alias("basis"))
    names = [f"b{i}" for i in range(1, len(knots) + 1)]
    wide = b.select("t", "y", *[F.col("basis")[i].alias(n) for i, n in enumerate(names, start=1)],
                    (F.col("t") - F.lit(t0)).cast("double").alias("x"))
    xs = ["x"] + names
    xtx, xty, _, _ = gram(wide, "y", xs)
    m = len(names)
    d = np.zeros((m - 2, m))
    for i in range(m - 2):
        d[i, i:i + 3] = [1.0, -2.0, 1.0]
    omega = np.zeros((len(xs) + 1, len(xs) + 1))
    omega[2:, 2:] = d.T @ d
    beta = linear.solve(xtx, xty, 10.0, omega=omega)
    return wide.select("t", "y", linear.predict(beta, xs).alias("fitted"))


@register("squared_loss_gd")
def squared_loss_gd(spark: SparkSession, sf: str) -> DataFrame:
    """Linear model with squared loss trained by distributed gradient sums (Nesterov); rows-only check."""
    hist = nets.train(_binary(spark, sf), 65, nets.squared_grad, rate=0.5, lam=0.0, iters=30)
    return spark.createDataFrame([(h["iteration"], h["loss"], h["grad_norm"]) for h in hist],
                                 "iteration int, loss double, grad_norm double")
