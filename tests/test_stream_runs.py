"""Run lengths kept by a stream against the batch operator."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import events
from lodestar.streaming import runs


def test_follow_in_any_split():
    rng = np.random.default_rng(1)
    for _ in range(200):
        days = [(int(d), bool(rng.random() < 0.7)) for d in np.flatnonzero(rng.random(40) < 0.9)]
        whole = runs.follow(None, None, None, days, 3)
        cut = int(rng.integers(0, len(days) + 1))
        assert runs.follow(*runs.follow(None, None, None, days[:cut], 3), days[cut:], 3) == whole
        up = [d for d, above in days if above]
        starts = [d for d in up if d + 1 in up and d + 2 in up]
        assert whole[2] == ((starts[0], starts[0] + 2) if starts else None)


@pytest.mark.parametrize("lateness", [None, 40])
def test_stream_over_many_files_out_of_order_equals_the_batch(spark, tmp_path, lateness):
    rng = np.random.default_rng(5)
    start = dt.datetime(2024, 3, 1)
    rows = []
    for day in range(24):
        for arm, share in (("a", 0.5 if day % 7 else 0.2), ("b", 0.3), ("c", 0.2)):
            for _ in range(int(round(40 * share * rng.uniform(0.8, 1.2)))):
                rows.append((len(rows), start + dt.timedelta(days=day, seconds=int(rng.integers(0, 86400))), arm, 60.0))
    rng.shuffle(rows)
    df = spark.createDataFrame([(int(i), t, a, float(v)) for i, t, a, v in rows], "event_id long, ts timestamp, event_type string, value double")
    df.unionByName(df.limit(50)).repartition(9).write.parquet(str(tmp_path / "events.parquet"))  # some events come twice
    counts = df.groupBy(F.datediff(F.to_date("ts"), F.lit("2024-03-01")).alias("day"), F.col("event_type").alias("arm")).count()
    total = counts.groupBy("day").agg(F.sum("count").alias("total"))
    shares = counts.join(total, "day").select("arm", (F.col("day") + 1).alias("step"), (F.col("count") / F.col("total")).alias("share"))
    first = (start - dt.datetime(1970, 1, 1)).days
    want = {r.arm: first + r.run_start for r in events.stable_run(shares, 0.28, 3, -1).collect()}
    got = runs.stream_stable_runs(spark, str(tmp_path), 0.28, 4, lateness_days=lateness, files_per_trigger=1)
    assert {r.arm: r.run_start for r in got.collect() if r.run_start is not None} == want
    assert all(r.reached == r.run_start + 3 for r in got.collect() if r.run_start is not None) and got.count() == 3


def test_closed_days_leave_the_state(spark, tmp_path):
    """Files in time order with a bound of one day: a later event for a closed day changes nothing, runs reach across closed days."""
    start = dt.datetime(2024, 3, 1, 12)
    folder = tmp_path / "events.parquet"
    for day in range(12):
        rows = [(day * 10 + i, start + dt.timedelta(days=day), "a" if i < 6 else "b", 1.0) for i in range(10)]
        if day == 11:  # far too late: would end the run
            rows += [(1000 + i, start + dt.timedelta(days=2), "b", 1.0) for i in range(50)]
        spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double").coalesce(1).write.mode("append").parquet(str(folder))
    got = {r.arm: r for r in runs.stream_stable_runs(spark, str(tmp_path), 0.5, 9, lateness_days=1, files_per_trigger=1).collect()}
    first = (dt.datetime(2024, 3, 1) - dt.datetime(1970, 1, 1)).days
    assert (got["a"].run_start, got["a"].reached, got["a"].current) == (first, first + 8, 12)
    assert got["b"].run_start is None and got["b"].current is None


def test_no_events(spark, tmp_path):
    spark.createDataFrame([], "event_id long, ts timestamp, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    assert runs.stream_stable_runs(spark, str(tmp_path), 0.5, 2).count() == 0
