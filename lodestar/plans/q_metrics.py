"""Ranking/classification metrics and samplers over scored documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import metrics, sampling
from lodestar.plans import derived
from lodestar.plans.derived import SCORED_SQL
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R
from lodestar.session import table

_AP_SQL = f"""s AS ({SCORED_SQL}),
g AS (SELECT {{by}} score, sum(label) AS pos, count(*) AS n FROM s GROUP BY {{by}} score),
c AS (SELECT *, sum(pos) OVER (PARTITION BY {{part}} ORDER BY score DESC) AS cum_pos,
             sum(n) OVER (PARTITION BY {{part}} ORDER BY score DESC) AS cum_n FROM g)"""


@register("average_precision", sql=f"""
WITH {_AP_SQL.format(by='', part='1')}
SELECT {R('sum(pos * cum_pos / cum_n) / sum(pos)')} AS ap, CAST(sum(pos) AS BIGINT) AS n_pos FROM c
""")
def average_precision_q(spark: SparkSession, sf: str) -> DataFrame:
    """Exact AP of n_chars as a quality score (ties grouped)."""
    ap = metrics.average_precision(derived.scored_docs(spark, sf), "score", "label")
    return ap.select(V.rnd("ap").alias("ap"), F.col("n_pos").cast("long"))


@register("ap_by_lang", sql=f"""
WITH {_AP_SQL.format(by='lang,', part='lang')}
SELECT lang, {R('sum(pos * cum_pos / cum_n) / sum(pos)')} AS ap, CAST(sum(pos) AS BIGINT) AS n_pos FROM c GROUP BY lang
""")
def ap_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    """A10: AP per class (language)."""
    ap = metrics.average_precision(derived.scored_docs(spark, sf), "score", "label", ["lang"])
    return ap.select("lang", V.rnd("ap").alias("ap"), F.col("n_pos").cast("long"))


@register("mean_ap", sql=f"""
WITH {_AP_SQL.format(by='lang,', part='lang')},
a AS (SELECT lang, sum(pos * cum_pos / cum_n) / sum(pos) AS ap FROM c GROUP BY lang)
SELECT {R('avg(ap)')} AS map, count(*) AS n_classes FROM a WHERE ap IS NOT NULL
""")
def mean_ap(spark: SparkSession, sf: str) -> DataFrame:
    """A10 macro mean over classes."""
    ap = metrics.average_precision(derived.scored_docs(spark, sf), "score", "label", ["lang"])
    m = metrics.mean_average_precision(ap)
    return m.select(V.rnd("map").alias("map"), "n_classes")


@register("pr_curve", sql=f"""
WITH {_AP_SQL.format(by='', part='1')}
SELECT score, CAST(cum_pos AS BIGINT) AS cum_pos, CAST(cum_n AS BIGINT) AS cum_n, {R('cum_pos / cum_n')} AS precision,
  {R('cum_pos / sum(pos) OVER ()')} AS recall FROM c
""")
def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    """The cumulative precision/recall curve behind AP."""
    counts = metrics.score_counts(derived.scored_docs(spark, sf), "score", "label")
    c = metrics.precision_recall_curve(counts)
    return c.select("score", F.col("cum_pos").cast("long"), F.col("cum_n").cast("long"),
                    V.rnd("precision").alias("precision"), V.rnd("recall").alias("recall"))


@register("best_threshold", sql=f"""
WITH s AS ({SCORED_SQL}),
g AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM s GROUP BY score),
c AS (SELECT score, coalesce(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
        coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
        sum(neg) OVER () AS total_neg FROM g),
e AS (SELECT score, pos_below + total_neg - neg_below AS errors FROM c)
SELECT score AS threshold, CAST(errors AS BIGINT) AS errors FROM e ORDER BY errors, score DESC LIMIT 1
""")
def best_threshold_q(spark: SparkSession, sf: str) -> DataFrame:
    """The score cut with the fewest errors, found in one grouped pass."""
    b = metrics.best_threshold(derived.scored_docs(spark, sf), "score", "label")
    return b.select("threshold", F.col("errors").cast("long"))


@register("class_prevalence", sql="""
SELECT 'quality' AS label, round(avg(quality), 6) + 0.0 AS prevalence, count(*) AS n FROM labels
UNION ALL SELECT 'toxic', round(avg(toxic), 6) + 0.0, count(*) FROM labels
""")
def class_prevalence_q(spark: SparkSession, sf: str) -> DataFrame:
    """A5: share of positives per label column."""
    p = metrics.class_prevalence(table(spark, sf, "labels"), ["quality", "toxic"])
    return p.select("label", V.rnd("prevalence").alias("prevalence"), "n")


@register("misclassification_rate", sql=f"""
WITH s AS ({SCORED_SQL})
SELECT lang, {R('avg(CAST(CAST(score > 1500 AS INTEGER) <> label AS DOUBLE))')} AS error_rate, count(*) AS n FROM s GROUP BY lang
""")
def misclassification_rate_q(spark: SparkSession, sf: str) -> DataFrame:
    """Error of the rule n_chars > 1500 → good, per language."""
    s = derived.scored_docs(spark, sf)
    m = metrics.misclassification_rate(s, metrics.threshold("score", 1500), "label", ["lang"])
    return m.select("lang", V.rnd("error_rate").alias("error_rate"), "n")


@register("regression_errors", sql=f"""
WITH r AS (SELECT l_quantity * 1.5 AS pred, l_extendedprice / 1000.0 AS y, l_returnflag FROM lineitem)
SELECT l_returnflag, {R('avg((pred - y) * (pred - y))')} AS mse, {R('sqrt(avg((pred - y) * (pred - y)))')} AS rmse,
  {R('avg((pred - y) * (pred - y)) / 2.0')} AS half_mse FROM r GROUP BY l_returnflag
""")
def regression_errors_q(spark: SparkSession, sf: str) -> DataFrame:
    """MSE, RMSE and half MSE of price/1000 predicted as 1.5 × quantity."""
    li = table(spark, sf, "lineitem").select((F.col("l_quantity") * 1.5).alias("pred"),
                                             (F.col("l_extendedprice") / 1000.0).alias("y"), "l_returnflag")
    e = metrics.regression_errors(li, "pred", "y", ["l_returnflag"])
    return e.select("l_returnflag", V.rnd("mse").alias("mse"), V.rnd("rmse").alias("rmse"), V.rnd("half_mse").alias("half_mse"))


@register("log_loss", sql=f"""
WITH s AS ({SCORED_SQL}), z AS (SELECT (score - 3000.0) / 1000.0 AS z, label FROM s),
p AS (SELECT z, label, least(greatest(1.0 / (1.0 + exp(-z)), 1e-15), 1 - 1e-15) AS p FROM z)
SELECT {R('avg(-(label * ln(p) + (1 - label) * ln(1 - p)))')} AS log_loss,
  {R('avg(greatest(z, 0.0) + ln(1 + exp(-abs(z))) - label * z)')} AS logit_loss FROM p
""")
def log_loss_q(spark: SparkSession, sf: str) -> DataFrame:
    """Log loss in probability form and in stable logit (softplus) form."""
    s = derived.scored_docs(spark, sf).withColumn("z", (F.col("score") - 3000.0) / 1000.0)
    s = s.withColumn("p", V.sigmoid("z"))
    return s.agg(V.rnd(metrics.log_loss_expr("p", "label")).alias("log_loss"),
                 V.rnd(metrics.logit_loss_expr("z", "label")).alias("logit_loss"))


@register("score_or_positive", sql=f"""
WITH s AS ({SCORED_SQL}) SELECT lang, count(*) AS kept FROM s WHERE score > 5000 OR label = 1 GROUP BY lang
""")
def score_or_positive(spark: SparkSession, sf: str) -> DataFrame:
    """Keep rows scored above a threshold or labelled positive."""
    s = derived.scored_docs(spark, sf).where((F.col("score") > 5000) | (F.col("label") == 1))
    return s.groupBy("lang").agg(F.count("*").alias("kept"))


_H = sampling.hash_order_sql("o_orderkey")


@register("cap_per_class", sql=f"""
WITH k AS (SELECT o_orderpriority, o_orderkey FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_H}, o_orderkey) <= 1000)
SELECT o_orderpriority, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM k GROUP BY o_orderpriority
""")
def cap_per_class_q(spark: SparkSession, sf: str) -> DataFrame:
    """At most 1,000 orders per priority, seeded hash order (a sampling operator: the cap is the feature)."""
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    c = sampling.cap_per_class(o, "o_orderpriority", "o_orderkey", 1000)
    return c.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("o_orderkey").cast("long").alias("key_sum"))


@register("split_train_test", sql=f"""
SELECT CASE WHEN {_H} / {float(sampling.HASH_MOD)!r} < 0.33 THEN 'test' ELSE 'train' END AS split, count(*) AS n FROM orders GROUP BY 1
""")
def split_train_test_q(spark: SparkSession, sf: str) -> DataFrame:
    """Reproducible 67/33 train/test split by key hash."""
    o = sampling.split_train_test(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.33)
    return o.groupBy("split").agg(F.count("*").alias("n"))


@register("given_split", sql=f"""
WITH s AS ({SCORED_SQL})
SELECT CASE WHEN toxic = 0 THEN 'train' ELSE 'test' END AS split, count(*) AS n, {R('avg(score)', 4)} AS mean_score FROM s GROUP BY 1
""")
def given_split_q(spark: SparkSession, sf: str) -> DataFrame:
    """T4: split taken from an external indicator column (toxic) joined on the id."""
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    s = sampling.given_split(d, table(spark, sf, "labels"), "doc_id", "toxic", 0)
    return s.groupBy("split").agg(F.count("*").alias("n"), V.rnd(F.avg("score"), 4).alias("mean_score"))


@register("hard_negatives", sql=f"""
WITH s AS ({SCORED_SQL}),
np AS (SELECT lang, count(*) AS P FROM s WHERE label = 1 GROUP BY lang),
n AS (SELECT s.*, coalesce(np.P, 0) AS P, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, doc_id) AS h
      FROM s LEFT JOIN np USING (lang) WHERE label = 0),
hard AS (SELECT lang, doc_id, 'hard' AS source FROM n WHERE h <= P),
rnd AS (SELECT lang, doc_id, 'random' AS source FROM n WHERE h > P
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {sampling.hash_order_sql('doc_id')}, doc_id) <= P),
pos AS (SELECT lang, doc_id, 'positive' AS source FROM s WHERE label = 1),
u AS (SELECT * FROM hard UNION ALL SELECT * FROM rnd UNION ALL SELECT * FROM pos)
SELECT lang, source, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS id_sum FROM u GROUP BY lang, source
""")
def hard_negatives_q(spark: SparkSession, sf: str) -> DataFrame:
    """Positives + the P top-scored negatives + P hash-ordered other negatives, per language."""
    s = derived.scored_docs(spark, sf)
    m = sampling.hard_negatives(s, "doc_id", "score", "label", by=["lang"])
    return m.groupBy("lang", "source").agg(F.count("*").alias("n"), F.sum("doc_id").cast("long").alias("id_sum"))


@register("mini_batches", sql=f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {sampling.hash_order_sql('doc_id')}, doc_id) AS pos FROM labels)
SELECT CAST((pos - 1) // 64 AS BIGINT) AS batch_id, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS id_sum FROM r GROUP BY 1
""")
def mini_batches_q(spark: SparkSession, sf: str) -> DataFrame:
    """Disjoint shuffled batches of 64."""
    b = sampling.mini_batches(table(spark, sf, "labels").select("doc_id"), "doc_id", 64)
    return b.groupBy("batch_id").agg(F.count("*").alias("n"), F.sum("doc_id").cast("long").alias("id_sum"))


@register("first_n_matching", sql=f"""
WITH s AS ({SCORED_SQL})
SELECT lang, doc_id FROM s WHERE score > 1000 QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id) <= 20
""")
def first_n_matching_q(spark: SparkSession, sf: str) -> DataFrame:
    """Up to 20 rows per language among those scored above 1,000 (a top-k report)."""
    s = derived.scored_docs(spark, sf)
    f = sampling.first_n_matching(s, F.col("score") > 1000, "lang", [F.col("score").desc(), F.col("doc_id")], 20)
    return f.select("lang", "doc_id")


@register("assign_folds", sql="""
SELECT doc_id, CAST(ntile(10) OVER (ORDER BY doc_id) AS INTEGER) AS fold FROM labels
""")
def assign_folds_q(spark: SparkSession, sf: str) -> DataFrame:
    """Ten contiguous folds in id order (ntile semantics, numbered range by range)."""
    f = sampling.assign_folds(table(spark, sf, "labels").select("doc_id"), 10, ["doc_id"])
    return f.select("doc_id", "fold")


@register("bootstrap_sample", sql=f"""
WITH s AS ({SCORED_SQL}), u AS (SELECT lang, doc_id, {sampling.hash_order_sql('doc_id', 7)} / {float(sampling.HASH_MOD)!r} AS u FROM s),
p AS (SELECT k, sum(exp(-1.0) / gamma(j + 1.0)) AS upto FROM range(0, 15) a(k), range(0, 15) b(j) WHERE j <= k GROUP BY k),
d AS (SELECT lang, doc_id, count(*) AS draws FROM u JOIN p ON p.upto <= u.u GROUP BY lang, doc_id)
SELECT lang, CAST(sum(draws) AS BIGINT) AS n, CAST(sum(draws * doc_id) AS BIGINT) AS id_sum FROM d GROUP BY lang
""")
def bootstrap_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Bootstrap resample with replacement (Poisson draws from a seeded hash)."""
    s = sampling.bootstrap(derived.scored_docs(spark, sf), "doc_id", 1.0, seed=7)
    return s.groupBy("lang").agg(F.count("*").alias("n"), F.sum("doc_id").cast("long").alias("id_sum"))


@register("random_folds", sql=f"""
SELECT CAST({sampling.hash_order_sql('doc_id', 3)} % 5 + 1 AS INTEGER) AS fold, count(*) AS n FROM labels GROUP BY 1
""")
def random_folds(spark: SparkSession, sf: str) -> DataFrame:
    """W8 random variant: folds by seeded key hash."""
    f = sampling.assign_folds(table(spark, sf, "labels").select("doc_id"), 5, ["doc_id"], random_key="doc_id", seed=3)
    return f.groupBy("fold").agg(F.count("*").alias("n"))
