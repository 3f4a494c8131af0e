"""Tree queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import sampling, trees
from lodestar.plans import derived
from lodestar.plans.derived import VECTORS_SQL
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R

_BINS, _FOLDS = 12, 3


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return derived.vectors(spark, sf).select("vec_id", "label", "v", (sampling.hash_order("vec_id", 9) % _FOLDS + 1).cast("int").alias("fold"))


def _split_sql(out: str, rows: str) -> str:
    """Exhaustive search: the best (feature, threshold) of every (tree, node) of ``rows`` (tree, node, vec_id)."""
    return f"""
{out}_c AS (SELECT r.tree, r.node, x.f, x.b, x.label, count(*) AS n FROM {rows} r JOIN x USING (vec_id) GROUP BY ALL),
{out}_t AS (SELECT tree, node, f, label, sum(n) AS n FROM {out}_c GROUP BY ALL),
{out}_l AS (SELECT t.tree, t.node, t.f, e.b, t.label, t.n, coalesce(sum(c.n), 0) AS low FROM {out}_t t JOIN e USING (f)
  LEFT JOIN {out}_c c ON c.tree = t.tree AND c.node = t.node AND c.f = t.f AND c.label = t.label AND c.b <= e.b GROUP BY ALL),
{out}_s AS (SELECT tree, node, f, b, sum(low) AS n_low, sum(n - low) AS n_high, sum(n) AS n, sum(n * n) AS n2, sum(n) - max(n) AS wrong,
    sum(low * low)::DOUBLE / nullif(sum(low), 0) + sum((n - low) * (n - low))::DOUBLE / nullif(sum(n - low), 0) AS score,
    sum(low) - max(low) + sum(n - low) - max(n - low) AS wrong_after, arg_max(label, (low, -label)) AS label_low, arg_max(label, (n - low, -label)) AS label_high,
    arg_max(label, (n, -label)) AS label_whole
  FROM {out}_l GROUP BY tree, node, f, b HAVING sum(low) > 0 AND sum(n - low) > 0),
{out} AS MATERIALIZED (SELECT s.*, e.edge FROM {out}_s s JOIN e USING (f, b) WHERE wrong > 0 AND score > n2::DOUBLE / n * (1 + 1e-12)
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, f, b) = 1)"""


_TREES_SQL = f"""
v AS ({VECTORS_SQL}), h AS (SELECT vec_id, label, v, CAST({sampling.hash_order_sql('vec_id', 9)} % {_FOLDS} + 1 AS INTEGER) AS fold FROM v),
u AS (SELECT vec_id, label, i - 1 AS f, v[i] AS z FROM v, range(1, 65) r(i)),
m AS (SELECT f, min(z) AS lo, max(z) AS hi FROM u GROUP BY f),
e AS MATERIALIZED (SELECT f, b, lo + (hi - lo) * (b + 1) / {_BINS} AS edge FROM m, range(0, {_BINS - 1}) r(b)),
x AS MATERIALIZED (SELECT u.vec_id, u.label, u.f, any_value(u.z) AS z, count(e.edge) AS b FROM u LEFT JOIN e ON e.f = u.f AND e.edge < u.z GROUP BY u.vec_id, u.label, u.f),
k(tree) AS (SELECT * FROM range(0, {_FOLDS + 1})),
r0 AS (SELECT tree, 0 AS node, vec_id FROM h, k WHERE tree = 0 OR fold <> tree),
{_split_sql("s0", "r0")},
r1 AS (SELECT r0.tree, CASE WHEN x.z <= s0.edge THEN 1 ELSE 2 END AS node, r0.vec_id FROM r0 JOIN s0 USING (tree) JOIN x ON x.vec_id = r0.vec_id AND x.f = s0.f),
{_split_sql("s1", "r1")}"""


def _forest(spark: SparkSession, sf: str, max_depth: int) -> trees.Forest:
    d = _rows(spark, sf)
    classes = d.agg(F.max("label") + 1).first()[0]
    forest = trees.Forest(d, trees.equal_width_edges(d, "v", _BINS), classes, _FOLDS, fold="fold", max_depth=max_depth)
    forest.grow()
    forest.close()
    return forest


@register("tree_first_splits", sql=f"""
WITH {_TREES_SQL}
SELECT CAST(tree AS INTEGER) AS tree, node, CAST(f AS INTEGER) AS feature, {R('edge')} AS threshold, CAST(n_low AS BIGINT) AS n_left, CAST(n_high AS BIGINT) AS n_right
FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s1)
""")
def tree_first_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The splits of the root and its children, for the tree over all rows and those without one of three folds, all grown in the same scans."""
    out = []
    for number, t in enumerate(_forest(spark, sf, 2).trees):
        for node in (0, 1, 2):
            if node < len(t.counts) and t.feature[node] >= 0:
                out.append((number, node, t.feature[node], t.threshold[node], int(t.counts[t.left[node]].sum()), int(t.counts[t.right[node]].sum())))
    return spark.createDataFrame(out, "tree int, node int, feature int, threshold double, n_left long, n_right long").withColumn("threshold", V.rnd("threshold"))


@register("tree_cv_errors", sql=f"""
WITH {_TREES_SQL},
o AS (SELECT h.vec_id, h.label, s0.tree, s0.label_low, s0.label_high, CASE WHEN x.z <= s0.edge THEN 1 ELSE 2 END AS node
  FROM h JOIN s0 ON s0.tree IN (0, h.fold) JOIN x ON x.vec_id = h.vec_id AND x.f = s0.f),
p AS (SELECT o.tree, o.label, CASE WHEN s1.f IS NULL THEN CASE o.node WHEN 1 THEN o.label_low ELSE o.label_high END
    WHEN x.z <= s1.edge THEN s1.label_low ELSE s1.label_high END AS predicted
  FROM o LEFT JOIN s1 ON s1.tree = o.tree AND s1.node = o.node LEFT JOIN x ON x.vec_id = o.vec_id AND x.f = s1.f),
g AS (SELECT s0.wrong, s0.n, coalesce(sum(s1.wrong - s1.wrong_after), 0) + any_value(s0.wrong - s0.wrong_after) AS gain, count(s1.f) + 1 AS splits,
    min((s1.wrong - s1.wrong_after)::DOUBLE / s0.n) AS weakest FROM s0 LEFT JOIN s1 USING (tree) WHERE s0.tree = 0 GROUP BY s0.wrong, s0.n)
SELECT count(*) FILTER (tree > 0) AS rows, count(*) FILTER (tree > 0 AND predicted <> label) AS held_out_wrong, count(*) FILTER (tree = 0 AND predicted <> label) AS train_wrong,
  {R('max(least(coalesce(weakest, 1e9), gain::DOUBLE / n / splits))')} AS first_alpha FROM p, g
""")
def tree_cv_errors(spark: SparkSession, sf: str) -> DataFrame:
    """M20 + M24: trees of depth two: wrong rows of the left-out folds by their own trees, wrong training rows of the whole tree, and its weakest link."""
    forest = _forest(spark, sf, 2)
    whole = forest.trees[0]
    held = forest.held_out([[t.wrong() < 0] for t in forest.trees[1:]]).sum(axis=0)[0]
    leaves = [i for i in range(len(whole.counts)) if whole.feature[i] < 0]
    cut, sequence = trees.weakest_links(whole)
    first = min(c for i, c in enumerate(cut) if whole.feature[i] >= 0)
    out = (int(held[1]), int(held[0]), int(whole.wrong()[leaves].sum()), float(first))
    return spark.createDataFrame([out], "rows long, held_out_wrong long, train_wrong long, first_alpha double").withColumn("first_alpha", V.rnd("first_alpha"))


@register("pruned_tree_sequence")
def pruned_tree_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """The whole sequence of pruned trees (depth up to 8) with training and held-out errors, the best size and the one-standard-error choice."""
    rows = trees.prune(_forest(spark, sf, 8))
    out = [(i, r["alpha"], r["leaves"], r["train_error"], r["cv_error"], r["se"], r["is_best"], r["one_se_choice"]) for i, r in enumerate(rows)]
    return spark.createDataFrame(out, "step int, alpha double, leaves int, train_error double, cv_error double, se double, is_best boolean, one_se_choice boolean")
