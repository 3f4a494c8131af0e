"""Vector-core queries: neighbours, votes, AP per label, pair kernels, vector functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.operators import metrics, similarity
from lodestar.plans import derived
from lodestar.plans.derived import VECTORS_SQL
from lodestar.plans.registry import register

K = 10

_NB_SQL = f"""v AS ({VECTORS_SQL}),
nb AS (
  SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, b.label AS label,
         sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS distance
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY distance, b.vec_id) <= {K}
)"""


def neighbours(spark: SparkSession, sf: str, k: int = K) -> DataFrame:
    v = derived.vectors(spark, sf)
    return similarity.knn_join(v, v, k, exclude_self=True, carry=[("label", "int")])


def label_ap(nb: DataFrame, truth: DataFrame) -> DataFrame:
    """AP per label of the vote-share score; queries with no vote for a label score 0.

    The zero-score group is added from class totals, so no (query × label)
    grid is ever built.
    """
    shares = similarity.vote_share(nb, "label").select(
        "query_id", F.col("label").alias("cls"), F.col("share").alias("score")
    )
    t = truth.select(F.col("vec_id").alias("query_id"), F.col("label").alias("truth"))
    scored = shares.join(t, "query_id").withColumn("y", (F.col("cls") == F.col("truth")).cast("long"))
    nz = scored.groupBy("cls", "score").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    nz_tot = nz.groupBy("cls").agg(F.sum("pos").alias("nz_pos"), F.sum("n").alias("nz_n"))
    cls_tot = t.groupBy(F.col("truth").alias("cls")).agg(F.count("*").alias("p_c")).withColumn(
        "n_all", F.sum("p_c").over(Window.partitionBy())  # one row per label
    )
    zero = cls_tot.join(nz_tot, "cls", "left").select(
        "cls", F.lit(0.0).alias("score"),
        (F.col("p_c") - F.coalesce(F.col("nz_pos"), F.lit(0))).alias("pos"),
        (F.col("n_all") - F.coalesce(F.col("nz_n"), F.lit(0))).alias("n"),
    ).where(F.col("n") > 0)
    counts = nz.unionByName(zero)
    return metrics.average_precision_counts(counts, "score", ["cls"])


@register("knn_label_ap", sql=f"""
WITH {_NB_SQL},
sh AS (SELECT query_id, label AS cls, count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY query_id) AS score
       FROM nb GROUP BY query_id, label),
t AS (SELECT vec_id AS query_id, label AS truth FROM v),
grid AS (SELECT t.query_id, c.cls, CAST(t.truth = c.cls AS BIGINT) AS y, coalesce(sh.score, 0.0) AS score
         FROM t JOIN (SELECT DISTINCT label AS cls FROM v) c ON TRUE
         LEFT JOIN sh ON sh.query_id = t.query_id AND sh.cls = c.cls),
g AS (SELECT cls, score, sum(y) AS pos, count(*) AS n FROM grid GROUP BY cls, score),
c AS (SELECT *, sum(pos) OVER (PARTITION BY cls ORDER BY score DESC) AS cum_pos,
             sum(n) OVER (PARTITION BY cls ORDER BY score DESC) AS cum_n FROM g)
SELECT cls AS label, round(sum(pos * cum_pos / cum_n) / sum(pos), 6) AS ap, CAST(sum(pos) AS BIGINT) AS n_pos
FROM c GROUP BY cls
""")
def knn_label_ap(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: label every embedding by its 10 nearest others, AP per label."""
    v = derived.vectors(spark, sf)
    nb = similarity.knn_join(v, v, K, exclude_self=True, carry=[("label", "int")])
    ap = label_ap(nb, v)
    return ap.select(F.col("cls").alias("label"), F.round("ap", 6).alias("ap"), F.col("n_pos").cast("long"))


# ------------------------------------------------------------------ helpers
from lodestar.functions import vectors as V  # noqa: E402
from lodestar.operators import imaging, moments  # noqa: E402
from lodestar.operators.prefix import global_row_number  # noqa: E402
from lodestar.plans.sqlfrag import DOT, NORM, R, SQD  # noqa: E402


def _next_pairs(v: DataFrame) -> DataFrame:
    """Each vector with the one that follows it in id order: an equi-join on places, so gaps in the ids lose nothing."""
    p = global_row_number(v.select("vec_id", "v"), [("vec_id", True)], "place")
    a = p.select("vec_id", F.col("v").alias("a"), "place")
    return a.join(p.select(F.col("vec_id").alias("next_id"), F.col("v").alias("b"), (F.col("place") - 1).alias("place")), "place")


_PAIRS_SQL = f"""v AS ({VECTORS_SQL}),
pr AS (SELECT vec_id, next_id, a, b FROM (SELECT vec_id, v AS a, lead(v) OVER (ORDER BY vec_id) AS b, lead(vec_id) OVER (ORDER BY vec_id) AS next_id FROM v)
       WHERE next_id IS NOT NULL)"""


@register("vector_pair_functions", sql=f"""
WITH {_PAIRS_SQL}
SELECT vec_id, {R(DOT('a', 'b'))} AS dot, {R(NORM('a'))} AS norm,
  {R('sqrt(' + SQD('a', 'b') + ')')} AS distance,
  {R(DOT('a', 'b') + ' / (' + NORM('a') + ' * ' + NORM('b') + ')')} AS cosine,
  {R('exp(-' + SQD('a', 'b') + ' / 1.0)')} AS rbf,
  {R('CASE WHEN ' + DOT('a', 'b') + ' = 1.0 THEN 3.0 ELSE (1.0 - pow(' + DOT('a', 'b') + ', 3.0)) / (1.0 - ' + DOT('a', 'b') + ') END')} AS vovk
FROM pr
""")
def vector_pair_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Dot, norm, distance, cosine, RBF and Vovk kernels on consecutive-id pairs."""
    p = _next_pairs(derived.vectors(spark, sf))
    return p.select(
        "vec_id", V.rnd(V.dot("a", "b")).alias("dot"), V.rnd(V.l2norm("a")).alias("norm"),
        V.rnd(V.l2_distance("a", "b")).alias("distance"), V.rnd(V.cosine("a", "b")).alias("cosine"),
        V.rnd(V.rbf("a", "b", 1.0)).alias("rbf"), V.rnd(V.vovk("a", "b", 3)).alias("vovk"),
    )


@register("vector_activations", sql=f"""
WITH v AS ({VECTORS_SQL}),
s AS (SELECT vec_id, v, list_max(v) AS m FROM v)
SELECT vec_id, {R('1.0 / (1.0 + exp(-v[1]))')} AS sigmoid_first,
  {R('list_sum(list_transform(v, lambda x: greatest(x, 0.0)))')} AS relu_sum,
  {R('1.0 / list_sum(list_transform(v, lambda x: exp(x - m)))')} AS softmax_max,
  CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS argmax,
  CAST(list_position(v, list_min(v)) - 1 AS INTEGER) AS argmin
FROM s
""")
def vector_activations(spark: SparkSession, sf: str) -> DataFrame:
    """Sigmoid, ReLU, softmax and first-maximum decoding per vector."""
    v = derived.vectors(spark, sf)
    return v.select(
        "vec_id", V.rnd(V.sigmoid(F.col("v")[0])).alias("sigmoid_first"),
        V.rnd(V.vsum(F.transform("v", V.relu))).alias("relu_sum"),
        V.rnd(F.array_max(V.softmax("v"))).alias("softmax_max"),
        V.argmax("v").alias("argmax"), V.argmin("v").alias("argmin"),
    )


@register("vector_thresholds", sql=f"""
WITH v AS ({VECTORS_SQL})
SELECT vec_id,
  {R('list_sum(list_transform(v, lambda x: CASE WHEN abs(x) > 0.1 THEN x ELSE 0.0 END))')} AS hard_sum,
  {R('list_sum(list_transform(v, lambda x: sign(x) * greatest(abs(x) - 0.1, 0.0)))')} AS soft_sum,
  {R('list_sum(list_transform(v, lambda x: 1.0 / (1.0 + (0.1 * 0.1) / (x * x))))')} AS shrink_sum
FROM v
""")
def vector_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """hard / soft thresholding at 0.1 and shrinkage γ/(γ+σ²/a²) at γ=1, σ=0.1."""
    v = derived.vectors(spark, sf)
    return v.select(
        "vec_id",
        V.rnd(V.vsum(F.transform("v", lambda x: V.hard_threshold(x, 0.1)))).alias("hard_sum"),
        V.rnd(V.vsum(F.transform("v", lambda x: V.soft_threshold(x, 0.1)))).alias("soft_sum"),
        V.rnd(V.vsum(F.transform("v", lambda x: V.shrink(x, 1.0, 0.1)))).alias("shrink_sum"),
    )


@register("one_hot_labels", sql="""
SELECT vec_id, label, array_to_string(list_transform(range(0, (SELECT max(label) + 1 FROM embeddings)), lambda i: CAST(i = label AS INTEGER)), ',') AS one_hot
FROM embeddings
""")
def one_hot_labels(spark: SparkSession, sf: str) -> DataFrame:
    """One-hot targets over classes 0 to the largest label (shown as text)."""
    v = derived.vectors(spark, sf)
    classes = v.agg(F.max("label") + 1).first()[0]  # one number
    return v.select("vec_id", "label", F.array_join(V.one_hot("label", classes).cast("array<string>"), ",").alias("one_hot"))


@register("filter_two_classes", sql="""
SELECT vec_id, label, CASE WHEN label = 3 THEN 1 ELSE -1 END AS y FROM embeddings WHERE label IN (3, 8)
""")
def filter_two_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Keep two classes and recode them to ±1."""
    v = derived.vectors(spark, sf)
    return v.where(F.col("label").isin(3, 8)).select(
        "vec_id", "label", F.when(F.col("label") == 3, 1).otherwise(-1).alias("y"))


@register("average_adjacent", sql=f"""
WITH v AS ({VECTORS_SQL}),
a AS (SELECT vec_id, list_transform(range(0, CAST(len(v) / 2 AS BIGINT)), lambda i: (v[2 * i + 1] + v[2 * i + 2]) / 2.0) AS m FROM v)
SELECT vec_id, CAST(len(m) AS INTEGER) AS n, {R('m[1]')} AS first, {R('list_sum(m)')} AS total FROM a
""")
def average_adjacent(spark: SparkSession, sf: str) -> DataFrame:
    """Average adjacent positions (64 → 32)."""
    v = derived.vectors(spark, sf).select("vec_id", V.average_adjacent("v", 2).alias("m"))
    return v.select("vec_id", F.size("m").alias("n"), V.rnd(F.col("m")[0]).alias("first"),
                    V.rnd(V.vsum("m")).alias("total"))


@register("add_intercept", sql=f"""
WITH v AS ({VECTORS_SQL}), a AS (SELECT vec_id, list_concat([1.0::DOUBLE], v) AS x FROM v)
SELECT vec_id, CAST(len(x) AS INTEGER) AS n, {R('x[1]')} AS first, {R('list_sum(x)')} AS total FROM a
""")
def add_intercept(spark: SparkSession, sf: str) -> DataFrame:
    """Prepend the constant 1."""
    v = derived.vectors(spark, sf).select("vec_id", V.add_intercept("v").alias("x"))
    return v.select("vec_id", F.size("x").alias("n"), V.rnd(F.col("x")[0]).alias("first"),
                    V.rnd(V.vsum("x")).alias("total"))


@register("column_moments", sql=f"""
WITH v AS ({VECTORS_SQL}), e AS (SELECT r.i AS pos, v[r.i + 1] AS x FROM v, range(0, 64) r(i))
SELECT CAST(pos AS INTEGER) AS pos, {R('avg(x)')} AS mean, {R('var_samp(x)', 8)} AS var_samp,
  {R('var_pop(x)', 8)} AS var_pop, {R('stddev_samp(x)')} AS sd, {R('min(x)')} AS min, {R('max(x)')} AS max, count(x) AS n
FROM e GROUP BY pos
""")
def column_moments_q(spark: SparkSession, sf: str) -> DataFrame:
    """A1: mean, variances, sd, min, max per vector position."""
    s = moments.column_moments(derived.vectors(spark, sf))
    return s.select("pos", V.rnd("mean").alias("mean"), V.rnd("var_samp", 8).alias("var_samp"),
                    V.rnd("var_pop", 8).alias("var_pop"), V.rnd("sd").alias("sd"), V.rnd("min").alias("min"),
                    V.rnd("max").alias("max"), "n")


@register("covariance_matrix", sql=f"""
WITH v AS ({VECTORS_SQL}), e AS (SELECT vec_id, r.i AS pos, v[r.i + 1] AS x FROM v, range(0, 64) r(i))
SELECT CAST(a.pos AS INTEGER) AS i, CAST(b.pos AS INTEGER) AS j, {R('covar_samp(a.x, b.x)', 7)} AS cov
FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY a.pos, b.pos
""")
def covariance_matrix_q(spark: SparkSession, sf: str) -> DataFrame:
    """A2: sample covariance of the 64 positions from per-partition centred Gram blocks."""
    c = moments.covariance_matrix(derived.vectors(spark, sf))
    return c.select("i", "j", V.rnd("cov", 7).alias("cov"))


@register("class_priors", sql="""
SELECT label, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 6) + 0.0 AS prior FROM embeddings GROUP BY label
""")
def class_priors(spark: SparkSession, sf: str) -> DataFrame:
    """A4: class counts and priors."""
    from lodestar.operators.metrics import class_counts_and_priors

    p = class_counts_and_priors(derived.vectors(spark, sf), "label")
    return p.select("label", "n", V.rnd("prior").alias("prior"))


@register("knn_neighbours", sql=f"""
WITH {_NB_SQL}
SELECT query_id, neighbour_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank,
  {R('distance')} AS distance FROM nb
""")
def knn_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """J7 + W1: the 10 exact nearest other vectors of every vector."""
    nb = neighbours(spark, sf)
    return nb.select("query_id", "neighbour_id", "rank", V.rnd("distance").alias("distance"))


@register("knn_join_expression", sql=f"""
WITH {_NB_SQL}
SELECT query_id, neighbour_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank,
  {R('distance')} AS distance FROM nb
""")
def knn_join_expression(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + J7 with small cells (64 rows), so that queries visit many cells and their lists are merged."""
    v = derived.vectors(spark, sf)
    nb = similarity.knn_join(v, v, K, exclude_self=True, cell_rows=64)
    return nb.select("query_id", "neighbour_id", "rank", V.rnd("distance").alias("distance"))


@register("knn_vote_share", sql=f"""
WITH {_NB_SQL}
SELECT query_id, label, count(*) AS votes, {R('count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY query_id)')} AS share
FROM nb GROUP BY query_id, label
""")
def knn_vote_share(spark: SparkSession, sf: str) -> DataFrame:
    """Class shares among the 10 nearest."""
    s = similarity.vote_share(neighbours(spark, sf), "label")
    return s.select("query_id", "label", "votes", V.rnd("share").alias("share"))


_MANY_K_SQL = f"""v AS ({VECTORS_SQL}),
d AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, b.label AS label,
        sqrt({SQD('a.v', 'b.v')}) AS distance FROM v a JOIN v b ON a.vec_id <> b.vec_id),
nb AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM d QUALIFY rank <= 9),
ks AS (SELECT * FROM (VALUES (1), (3), (5), (7), (9)) t(k)),
agg AS (SELECT k, query_id, label, count(*) AS votes, min(distance) AS nearest FROM nb JOIN ks ON rank <= k GROUP BY k, query_id, label),
pred AS (SELECT k, query_id, label AS predicted FROM agg
         QUALIFY row_number() OVER (PARTITION BY k, query_id ORDER BY votes DESC, nearest, label) = 1)"""


@register("knn_classify_many_k", sql=f"""
WITH {_MANY_K_SQL}
SELECT CAST(k AS INTEGER) AS k, query_id, predicted FROM pred
""")
def knn_classify_many_k(spark: SparkSession, sf: str) -> DataFrame:
    """Leave-one-out kNN labels for k = 1, 3, 5, 7, 9 from one neighbour pass."""
    v = derived.vectors(spark, sf)
    return similarity.knn_classify_many_k(v, v, [1, 3, 5, 7, 9])


@register("knn_errors_by_k", sql=f"""
WITH {_MANY_K_SQL},
e AS (SELECT k, CAST(sum(CAST(p.predicted <> v.label AS BIGINT)) AS BIGINT) AS n_errors FROM pred p JOIN v ON p.query_id = v.vec_id GROUP BY k)
SELECT CAST(k AS INTEGER) AS k, n_errors, row_number() OVER (ORDER BY n_errors, k) = 1 AS is_best FROM e
""")
def knn_errors_by_k(spark: SparkSession, sf: str) -> DataFrame:
    """Leave-one-out errors per k and the best k."""
    from lodestar.operators.metrics import errors_by_k

    v = derived.vectors(spark, sf)
    p = similarity.knn_classify_many_k(v, v, [1, 3, 5, 7, 9])
    j = p.join(v.select(F.col("vec_id").alias("query_id"), "label"), "query_id")
    return errors_by_k(j, "k", "predicted", "label")


@register("knn_regress", sql=f"""
WITH {_MANY_K_SQL}
SELECT query_id, {R('avg(CAST(label AS DOUBLE))')} AS prediction FROM nb WHERE rank <= 5 GROUP BY query_id
""")
def knn_regress(spark: SparkSession, sf: str) -> DataFrame:
    """Mean label of the 5 nearest (leave-one-out)."""
    v = derived.vectors(spark, sf).withColumn("target", F.col("label").cast("double"))
    r = similarity.knn_regress(v, v, 5, "target", exclude_self=True)
    return r.select("query_id", V.rnd("prediction").alias("prediction"))


@register("nearest_per_label", sql=f"""
WITH {_NB_SQL}
SELECT query_id, label, neighbour_id, {R('distance')} AS distance FROM nb
QUALIFY row_number() OVER (PARTITION BY query_id, label ORDER BY distance, neighbour_id) = 1
""")
def nearest_per_label(spark: SparkSession, sf: str) -> DataFrame:
    """At most one neighbour per (query, label) among the 10 nearest."""
    d = similarity.dedupe_first_by_group(neighbours(spark, sf), "label")
    return d.select("query_id", "label", "neighbour_id", V.rnd("distance").alias("distance"))


@register("rank_within_class", sql=f"""
WITH v AS ({VECTORS_SQL}),
e AS (SELECT vec_id, label, r.i AS pos, v[r.i + 1] AS x FROM v, range(0, 64) r(i)),
c AS (SELECT label, pos, avg(x) AS m FROM e GROUP BY label, pos),
d AS (SELECT e.vec_id, e.label, sqrt(sum((e.x - c.m) * (e.x - c.m))) AS dist FROM e JOIN c ON e.label = c.label AND e.pos = c.pos GROUP BY e.vec_id, e.label)
SELECT vec_id, label, {R('dist')} AS distance, CAST(rank() OVER (PARTITION BY label ORDER BY {R('dist', 9)}) AS INTEGER) AS rank FROM d
""")
def rank_within_class(spark: SparkSession, sf: str) -> DataFrame:
    """Rank each vector by distance to its class centroid."""
    v = derived.vectors(spark, sf)
    cen = moments.column_moments(v, by=["label"]).groupBy("label").agg(
        F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("_c")
    ).select("label", F.transform("_c", lambda s: s["mean"]).alias("centroid"))
    d = v.join(cen, "label").select("vec_id", "label", V.l2_distance("v", "centroid").alias("dist"))
    d = d.withColumn("dist9", F.round("dist", 9))
    r = similarity.rank_within_class(d, "label", "dist9", "vec_id")
    return r.select("vec_id", "label", V.rnd("dist").alias("distance"), F.col("rank").cast("int"))


@register("kernel_class_sums", sql=f"""
WITH v AS ({VECTORS_SQL})
SELECT a.label AS class_i, b.label AS class_j, {R('sum(exp(-' + SQD('a.v', 'b.v') + ' / 1.0))', 4)} AS ksum, count(*) AS pairs
FROM v a JOIN v b ON TRUE GROUP BY a.label, b.label
""")
def kernel_class_sums(spark: SparkSession, sf: str) -> DataFrame:
    """A15 (over J3 blocks): Σ RBF(σ=1) within and across classes, no pair rows emitted."""
    v = derived.vectors(spark, sf)
    s = similarity.kernel_block_sum(v, v, "rbf", 1.0)
    return s.select("class_i", "class_j", V.rnd("ksum", 4).alias("ksum"), "pairs")


_VOVK = "(1.0 + {d} + {d} * {d})"


@register("kernel_class_sums_polynomial", sql=f"""
WITH v AS ({VECTORS_SQL}), k AS (SELECT a.label AS class_i, b.label AS class_j, {DOT('a.v', 'b.v')} AS d FROM v a, v b)
SELECT class_i, class_j, {R('sum(d)', 5)} AS linear, {R('sum(' + _VOVK.format(d='d') + ')', 5)} AS vovk, count(*) AS pairs FROM k GROUP BY class_i, class_j
""")
def kernel_class_sums_polynomial(spark: SparkSession, sf: str) -> DataFrame:
    """A15 without pairs: linear and Vovk (p = 3) kernel sums of every two classes from sums of tensor powers."""
    v = derived.vectors(spark, sf)
    a = similarity.kernel_block_sum(v, v, "linear", 0.0).select("class_i", "class_j", V.rnd("ksum", 5).alias("linear"), "pairs")
    b = similarity.kernel_block_sum(v, v, "vovk", 3).select("class_i", "class_j", V.rnd("ksum", 5).alias("vovk"))
    return a.join(b, ["class_i", "class_j"])


@register("kernel_nearest_mean_polynomial", sql=f"""
WITH v AS ({VECTORS_SQL}),
k AS (SELECT a.vec_id AS test_id, a.label AS own, b.label, {DOT('a.v', 'b.v')} AS d FROM v a, v b),
rs AS (SELECT test_id, own, label, sum({_VOVK.format(d='d')}) AS ksum, count(*) AS n FROM k GROUP BY test_id, own, label),
w AS (SELECT label, sum(ksum) AS ksum_w FROM rs WHERE own = label GROUP BY label),
x AS (SELECT vec_id AS test_id, {DOT('v', 'v')} AS d FROM v),
d AS (SELECT rs.test_id, rs.label, {_VOVK.format(d='x.d')} - 2.0 * ksum / n + ksum_w / (n * n) AS dist2 FROM rs JOIN w USING (label) JOIN x USING (test_id))
SELECT test_id, label AS predicted, {R('dist2')} AS dist2 FROM d QUALIFY row_number() OVER (PARTITION BY test_id ORDER BY dist2, label) = 1
""")
def kernel_nearest_mean_polynomial(spark: SparkSession, sf: str) -> DataFrame:
    """M10 without pairs: nearest class mean under the Vovk kernel (p = 3), in two scans."""
    v = derived.vectors(spark, sf)
    return similarity.kernel_nearest_mean(v, v, "vovk", 3).select("test_id", "predicted", V.rnd("dist2").alias("dist2"))


@register("kernel_nearest_mean", sql=f"""
WITH v AS ({VECTORS_SQL}),
k AS (SELECT a.vec_id AS test_id, b.label, exp(-{SQD('a.v', 'b.v')} / 1.0) AS kv FROM v a JOIN v b ON TRUE),
rs AS (SELECT test_id, label, sum(kv) AS ksum FROM k GROUP BY test_id, label),
n AS (SELECT label, count(*) AS n FROM v GROUP BY label),
w AS (SELECT b.label, sum(k.kv) AS ksum_w FROM k JOIN v b ON k.label = b.label AND k.test_id = b.vec_id GROUP BY b.label),
d AS (SELECT rs.test_id, rs.label, 1.0 - 2.0 * rs.ksum / n.n + w.ksum_w / (n.n * n.n) AS dist2 FROM rs JOIN n USING (label) JOIN w USING (label))
SELECT test_id, label AS predicted, {R('dist2')} AS dist2 FROM d QUALIFY row_number() OVER (PARTITION BY test_id ORDER BY dist2, label) = 1
""")
def kernel_nearest_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest class mean in the RBF feature space."""
    v = derived.vectors(spark, sf)
    r = similarity.kernel_nearest_mean(v, v, "rbf", 1.0)
    return r.select("test_id", "predicted", V.rnd("dist2").alias("dist2"))


_PATCH_SQL = f"""v AS ({VECTORS_SQL}),
st AS (SELECT * FROM (VALUES (0), (2)) t(s)),
p AS (SELECT v.vec_id, r.s AS pr, c.s AS pc,
        flatten(list_transform(range(0, 5), lambda dr: list_slice(v.v, (r.s + dr) * 8 + c.s + 1, (r.s + dr) * 8 + c.s + 5))) AS patch
      FROM v, st r, st c)"""


@register("patches", sql=f"""
WITH {_PATCH_SQL}
SELECT vec_id, pr, pc, pr + 2.0 AS centre_r, pc + 2.0 AS centre_c, CAST(len(patch) AS INTEGER) AS n, {R('list_sum(patch)')} AS total FROM p
""")
def patches_q(spark: SparkSession, sf: str) -> DataFrame:
    """5×5 windows at stride 2 of each embedding viewed as an 8×8 grid."""
    p = imaging.patches(derived.vectors(spark, sf), "v", 8, 5, 2)
    return p.select("vec_id", "pr", "pc", "centre_r", "centre_c", F.size("patch").alias("n"),
                    V.rnd(V.vsum("patch")).alias("total"))


@register("normalized_patches", sql=f"""
WITH {_PATCH_SQL},
e AS (SELECT vec_id, pr, pc, r.i AS pos, patch[r.i + 1] AS x FROM p, range(0, 25) r(i)),
s AS (SELECT pos, avg(x) AS m, stddev_samp(x) AS sd FROM e GROUP BY pos),
z AS (SELECT vec_id, pr, pc, e.pos, (x - m) / sd AS z FROM e JOIN s USING (pos)),
n AS (SELECT vec_id, pr, pc, sqrt(sum(z * z)) AS nrm, sum(z) AS zs FROM z GROUP BY vec_id, pr, pc)
SELECT vec_id, pr, pc, {R('zs / nrm')} AS unit_sum FROM n
""")
def normalized_patches(spark: SparkSession, sf: str) -> DataFrame:
    """z-score each patch position with statistics over all patches, then unit length."""
    p = imaging.patches(derived.vectors(spark, sf), "v", 8, 5, 2)
    st = moments.mean_sd_arrays(p, "patch").first()  # 2×25 numbers, by the patch's shape
    mean, sd = (F.array(*[F.lit(float(x)) for x in st[c]]) for c in ("mean", "sd"))
    z = p.withColumns({"mean": mean, "sd": sd}).select("vec_id", "pr", "pc", V.normalize_patch("patch", "mean", "sd").alias("u"))
    return z.select("vec_id", "pr", "pc", V.rnd(V.vsum("u")).alias("unit_sum"))


@register("set_kernel", sql=f"""
WITH {_PATCH_SQL}
SELECT a.vec_id AS left_id, b.vec_id AS right_id, {R('sum(exp(-' + SQD('a.patch', 'b.patch') + ' / 4.0))')} AS kernel,
  count(*) AS patch_pairs
FROM p a JOIN (SELECT vec_id, lead(vec_id) OVER (ORDER BY vec_id) AS next_id FROM v) n ON n.vec_id = a.vec_id
  JOIN p b ON b.vec_id = n.next_id GROUP BY a.vec_id, b.vec_id
""")
def set_kernel_q(spark: SparkSession, sf: str) -> DataFrame:
    """set kernel Σ_patch-pairs RBF(σ=2) between each grid and the next-id grid."""
    v = derived.vectors(spark, sf)
    p = imaging.patches(v, "v", 8, 5, 2)
    pairs = _next_pairs(v).select(F.col("vec_id").alias("left_id"), F.col("next_id").alias("right_id"))
    s = imaging.set_kernel(pairs, p, p, 2.0)
    return s.select("left_id", "right_id", V.rnd("kernel").alias("kernel"), "patch_pairs")


@register("set_kernel_spatial", sql=f"""
WITH {_PATCH_SQL}
SELECT a.vec_id AS left_id, b.vec_id AS right_id,
  {R('sum(exp(-' + SQD('a.patch', 'b.patch') + ' / 4.0) * exp(-((a.pr - b.pr) * (a.pr - b.pr) + (a.pc - b.pc) * (a.pc - b.pc)) / 9.0))')} AS kernel
FROM p a JOIN (SELECT vec_id, lead(vec_id) OVER (ORDER BY vec_id) AS next_id FROM v) n ON n.vec_id = a.vec_id
  JOIN p b ON b.vec_id = n.next_id GROUP BY a.vec_id, b.vec_id
""")
def set_kernel_spatial(spark: SparkSession, sf: str) -> DataFrame:
    """F6, spatial: patch pairs also weighed by an RBF (σ=3) of the distance between their centres."""
    v = derived.vectors(spark, sf)
    p = imaging.patches(v, "v", 8, 5, 2)
    pairs = _next_pairs(v).select(F.col("vec_id").alias("left_id"), F.col("next_id").alias("right_id"))
    s = imaging.set_kernel(pairs, p, p, 2.0, spatial_sigma=3.0)
    return s.select("left_id", "right_id", V.rnd("kernel").alias("kernel"))


_W = [round(((i * 37) % 17 - 8) / 16.0, 4) for i in range(64)]


@register("linear_scores", sql=f"""
WITH v AS ({VECTORS_SQL})
SELECT vec_id, {R(DOT('v', '[' + ', '.join(f'{w}::DOUBLE' for w in _W) + ']') + ' + 0.25')} AS score,
  {R('1.0 / (1.0 + exp(-(' + DOT('v', '[' + ', '.join(f'{w}::DOUBLE' for w in _W) + ']') + ' + 0.25)))')} AS prob
FROM v
""")
def linear_scores(spark: SparkSession, sf: str) -> DataFrame:
    """linear score ⟨v, w⟩ + b with fixed weights, and its sigmoid."""
    v = derived.vectors(spark, sf)
    s = V.linear_score("v", _W, 0.25)
    return v.select("vec_id", V.rnd(s).alias("score"), V.rnd(V.sigmoid(s)).alias("prob"))


@register("array_ops", sql=f"""
WITH v AS ({VECTORS_SQL}),
g AS (SELECT vec_id, v, list_transform(range(0, 8), lambda r: list_slice(v, r * 8 + 1, r * 8 + 8)) AS rows FROM v)
SELECT vec_id, {R('list_sum(list_transform(range(0, 8), lambda i: v[i * 8 + i + 1]))')} AS trace,
  {R('list_sum(list_transform(range(0, 8), lambda r: v[r * 8 + 1]))')} AS first_col_sum,
  {R('list_sum(flatten(list_slice(rows, 1, 2)))')} AS top_two_rows,
  CAST(len(list_concat(v, v)) AS INTEGER) AS concat_len,
  {R('v[64]')} AS last
FROM g
""")
def array_ops(spark: SparkSession, sf: str) -> DataFrame:
    """element access, slice, flatten, concat, transpose and diagonal on the 8×8 view."""
    v = derived.vectors(spark, sf).select("vec_id", "v", V.reshape_rows("v", 8).alias("rows"))
    transposed = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda c: F.transform("rows", lambda r: r[c]))
    return v.select(
        "vec_id",
        V.rnd(V.vsum(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.col("rows")[i][i]))).alias("trace"),
        V.rnd(V.vsum(transposed[0])).alias("first_col_sum"),
        V.rnd(V.vsum(F.flatten(F.slice("rows", 1, 2)))).alias("top_two_rows"),
        F.size(F.concat("v", "v")).alias("concat_len"),
        V.rnd(F.element_at("v", -1)).alias("last"),
    )
