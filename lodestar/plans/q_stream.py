"""Streaming queries (B3, B4): run to completion with availableNow and return the final state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.plans.derived import ARMS_SQL
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R
from lodestar.streaming import bandit, runs


@register("stream_arm_posteriors", sql=f"""
WITH a AS ({ARMS_SQL})
SELECT arm, count(*) AS pulls, CAST(sum(reward) + 1 AS BIGINT) AS alpha, CAST(count(*) - sum(reward) + 1 AS BIGINT) AS beta,
  {R('(sum(reward) + 1) * 1.0 / (count(*) + 2)')} AS mean FROM a GROUP BY arm
""")
def stream_arm_posteriors_q(spark: SparkSession, sf: str) -> DataFrame:
    """The streamed posterior state; must equal the batch posteriors (B1)."""
    s = bandit.stream_arm_posteriors(spark, sf)
    return s.select("arm", "pulls", "alpha", "beta", V.rnd("mean").alias("mean"))


@register("stream_daily_arm_share", sql=f"""
WITH a AS ({ARMS_SQL}), d AS (SELECT date_trunc('day', ts) AS day, arm, count(*) AS pulls FROM a GROUP BY 1, 2),
s AS (SELECT day, arm, pulls, pulls * 1.0 / sum(pulls) OVER (PARTITION BY day) AS share FROM d),
c AS (SELECT *, min(CAST(share > 0.19 AS INTEGER)) OVER w = 1 AND count(*) OVER w = 3 AS converged FROM s
      WINDOW w AS (PARTITION BY arm ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
SELECT CAST(epoch(day) AS BIGINT) AS day_epoch, arm, pulls, {R('share')} AS share, converged FROM c
""")
def stream_daily_arm_share_q(spark: SparkSession, sf: str) -> DataFrame:
    """Daily arm shares from a windowed stream, converged after 3 days above 0.19."""
    c = bandit.stream_daily_arm_counts(spark, sf)
    d = bandit.daily_share(c, 0.19, 3)
    return d.select(F.unix_seconds("day").alias("day_epoch"), "arm", "pulls", V.rnd("share").alias("share"), "converged")


@register("stream_stable_runs", sql=f"""
WITH a AS ({ARMS_SQL}), d AS (SELECT CAST(floor(epoch(ts) / 86400) AS INTEGER) AS day, arm, count(*) AS pulls FROM a GROUP BY 1, 2),
s AS (SELECT day, arm, pulls * 1.0 / sum(pulls) OVER (PARTITION BY day) AS share FROM d),
i AS (SELECT arm, day, day - row_number() OVER (PARTITION BY arm ORDER BY day) AS island FROM s WHERE share > 0.19),
r AS (SELECT arm, min(day) AS start, max(day) AS stop FROM i GROUP BY arm, island),
l AS (SELECT arm, max(day) AS last FROM s GROUP BY arm)
SELECT l.arm, min(start) FILTER (stop - start >= 2) AS run_start, CAST(min(start) FILTER (stop - start >= 2) + 2 AS INTEGER) AS reached,
  CAST(max(stop - start + 1) FILTER (stop = last) AS INTEGER) AS current
FROM l LEFT JOIN r ON r.arm = l.arm GROUP BY l.arm
""")
def stream_stable_runs_q(spark: SparkSession, sf: str) -> DataFrame:
    """The first run of three days with a share above 0.19, kept as state per arm by the stream, and the length of each arm's last run."""
    return runs.stream_stable_runs(spark, sf, 0.19, 3)
