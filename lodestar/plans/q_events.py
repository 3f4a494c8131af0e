"""Event-log queries: bandit state, running statistics, training curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import events, metrics
from lodestar.plans import derived
from lodestar.plans.derived import ARMS_SQL, HISTORY_SQL, SERIES_SQL
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R
from lodestar.session import domain, table

_ORDER = [("ts", True), ("event_id", True)]


def _arms(spark: SparkSession, sf: str) -> list[str]:
    """The arm domain (distinct event types; bounded)."""
    return domain(table(spark, sf, "events"), "event_type")


@register("running_mean_reward", sql=f"""
WITH a AS ({ARMS_SQL})
SELECT event_id, row_number() OVER w AS step, {R('avg(reward) OVER w')} AS running_mean
FROM a WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def running_mean_reward(spark: SparkSession, sf: str) -> DataFrame:
    """Mean reward after each step of the bandit log."""
    r = events.running_mean(derived.arms(spark, sf), _ORDER, "reward")
    return r.select("event_id", "step", V.rnd("running_mean").alias("running_mean"))


_SHARE_SQL = f"""a AS ({ARMS_SQL}),
s AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS step, arm FROM a),
ar AS (SELECT DISTINCT arm AS name FROM a),
sh AS (SELECT s.step, ar.name AS arm,
         sum(CAST(s.arm = ar.name AS BIGINT)) OVER (PARTITION BY ar.name ORDER BY s.step) * 1.0 / s.step AS share
       FROM s, ar)"""


@register("running_arm_share", sql=f"""
WITH {_SHARE_SQL}
SELECT step, arm, {R('share')} AS share FROM sh
""")
def running_arm_share(spark: SparkSession, sf: str) -> DataFrame:
    """Share of steps that pulled each arm so far."""
    r = events.running_share(derived.arms(spark, sf), _ORDER, "arm", _arms(spark, sf))
    return r.select("step", "arm", V.rnd("share").alias("share"))


@register("stable_run", sql=f"""
WITH {_SHARE_SQL},
f AS (SELECT arm, step, share > 0.2 AS good,
        min(CAST(share > 0.2 AS INTEGER)) OVER (PARTITION BY arm ORDER BY step ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS prev_ok,
        count(*) OVER (PARTITION BY arm ORDER BY step ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS prev_n FROM sh)
SELECT arm, min(step) - 1 - 10 AS run_start FROM f WHERE good AND prev_ok = 1 AND prev_n = 10 AND step - 1 > 10 GROUP BY arm
""")
def stable_run_q(spark: SparkSession, sf: str) -> DataFrame:
    """First index where an arm's running share stays above 0.2 for 10 steps (start of that run)."""
    sh = events.running_share(derived.arms(spark, sf), _ORDER, "arm", _arms(spark, sf))
    return events.stable_run(sh, 0.2, 10, 10).select("arm", F.col("run_start").cast("long"))


@register("first_difference_noise", sql=f"""
WITH s AS ({SERIES_SQL}), d AS (SELECT y - lag(y) OVER (ORDER BY t) AS d FROM s)
SELECT {R('sum(d * d)', 4)} AS sum_sq_diff, {R('sum(d * d) / (2.0 * ((SELECT count(*) FROM s) - 1))', 6)} AS noise_var,
  (SELECT count(*) FROM s) AS n FROM d
""")
def first_difference_noise_q(spark: SparkSession, sf: str) -> DataFrame:
    """Noise variance from first differences of the 6-hour series."""
    n = events.first_difference_noise(derived.series(spark, sf), "t", "y")
    return n.select(V.rnd("sum_sq_diff", 4).alias("sum_sq_diff"), V.rnd("noise_var").alias("noise_var"), "n")


@register("metric_every_half_epoch", sql=f"""
WITH h AS ({HISTORY_SQL}), k AS (SELECT * FROM h WHERE step % 500 = 0)
SELECT step, split, {R('metric')} AS metric, {R('max(metric) OVER (PARTITION BY split ORDER BY step)')} AS best_so_far FROM k
""")
def metric_every_half_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """Metric every 500 steps with the best value so far, per split."""
    m = events.metric_every(derived.history(spark, sf), 500, "step", "metric", by=["split"])
    return m.select("step", "split", V.rnd("metric").alias("metric"), V.rnd("best_so_far").alias("best_so_far"))


@register("train_test_gap", sql=f"""
WITH h AS ({HISTORY_SQL}), b AS (SELECT CAST(step // 1000 AS BIGINT) AS bucket, split, metric FROM h),
p AS (SELECT bucket, avg(metric) FILTER (WHERE split = 'train') AS train, avg(metric) FILTER (WHERE split = 'val') AS val FROM b GROUP BY bucket)
SELECT bucket, {R('train')} AS train, {R('val')} AS val, {R('val - train')} AS gap FROM p
""")
def train_test_gap_q(spark: SparkSession, sf: str) -> DataFrame:
    """Train and validation curves side by side per 1,000-step bucket (pivot)."""
    g = events.train_test_gap(derived.history(spark, sf), 1000, "step", "split", "metric")
    return g.select("bucket", V.rnd("train").alias("train"), V.rnd("val").alias("val"), V.rnd("gap").alias("gap"))


@register("best_checkpoint", sql=f"""
WITH h AS ({HISTORY_SQL})
SELECT event_type, arg_max(step, (metric, -step)) AS step, {R('max(metric)')} AS metric FROM h WHERE split = 'val' GROUP BY event_type
""")
def best_checkpoint_q(spark: SparkSession, sf: str) -> DataFrame:
    """Per model (event type), the step with the best validation metric (earliest on ties)."""
    h = derived.history(spark, sf).where(F.col("split") == "val")
    b = metrics.best_checkpoint(h, "event_type", "metric", "step")
    return b.select("event_type", "step", V.rnd("metric").alias("metric"))


@register("arm_posteriors", sql=f"""
WITH a AS ({ARMS_SQL})
SELECT arm, count(*) AS pulls, CAST(sum(reward) + 1 AS BIGINT) AS alpha, CAST(count(*) - sum(reward) + 1 AS BIGINT) AS beta,
  {R('(sum(reward) + 1) * 1.0 / (count(*) + 2)')} AS mean FROM a GROUP BY arm
""")
def arm_posteriors_q(spark: SparkSession, sf: str) -> DataFrame:
    """B1: Beta posterior of each arm's reward rate."""
    p = events.arm_posteriors(derived.arms(spark, sf), "arm", "reward")
    return p.select("arm", "pulls", "alpha", "beta", V.rnd("mean").alias("mean"))


@register("arm_intervals")
def arm_intervals_q(spark: SparkSession, sf: str) -> DataFrame:
    """B2: 2.5 % / 97.5 % posterior quantiles per arm (bisection on the incomplete beta); rows-only check."""
    p = events.arm_posteriors(derived.arms(spark, sf), "arm", "reward")
    i = events.arm_intervals(p)
    return i.select("arm", V.rnd("mean").alias("mean"), V.rnd("lower").alias("lower"), V.rnd("upper").alias("upper"))


@register("hinge_basis", sql=f"""
WITH s AS ({SERIES_SQL}), m AS (SELECT min(t) AS t0 FROM s),
q AS (SELECT max(t) - min(t) AS span FROM s),
b AS (SELECT s.t, list_concat([1.0::DOUBLE], list_transform([0.25, 0.5, 0.75]::DOUBLE[], lambda k: greatest((s.t - m.t0) - k * q.span, 0.0))) AS basis FROM s, m, q)
SELECT t, CAST(len(basis) AS INTEGER) AS n, {R('list_sum(basis)')} AS total, {R('basis[4]')} AS last FROM b
""")
def hinge_basis_q(spark: SparkSession, sf: str) -> DataFrame:
    """truncated-linear basis of the bucket index with knots at the quarters of its range."""
    s = derived.series(spark, sf)
    t0, span = s.agg(F.min("t"), F.max("t") - F.min("t")).first()  # two numbers
    b = s.select("t", V.hinge_basis(F.col("t") - F.lit(t0), [0.25 * span, 0.5 * span, 0.75 * span]).alias("basis"))
    return b.select("t", F.size("basis").alias("n"), V.rnd(V.vsum("basis")).alias("total"), V.rnd(F.col("basis")[3]).alias("last"))
