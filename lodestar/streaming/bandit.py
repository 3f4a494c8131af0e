"""Bandit log as a stream.

The events table is read with the file stream source, as one file or as a folder of part files; state
is kept per arm (B3) or per (window, arm) (B4).  ``availableNow`` processes everything that is there
and stops, so a test can compare the final state with the batch answer.

``lateness`` says how far out of order events may come.  The default None keeps the id of every event
and every window, so no event is lost however files are ordered.  A bound ("1 day") limits that state:
ids and windows older than the latest event by more are forgotten, and later events of that age are
not counted; the caller chooses this.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import cut_lineage, discard, is_folder, scratch


def event_stream(spark: SparkSession, src_dir: str, name: str = "events", lateness: str | None = None,
                 files_per_trigger: int = 1000) -> DataFrame:
    """The events as a stream of (event_id, ts, arm, reward), each event id once."""
    path = f"{src_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if is_folder(spark, path):
        s = reader.parquet(path)
    else:
        s = reader.option("pathGlobFilter", f"{name}.parquet").parquet(src_dir)
    s = s.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("arm"),
                 (F.col("value") > 50).cast("int").alias("reward"))
    if lateness is None:
        return s.dropDuplicates(["event_id"])
    return s.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])


def _run(spark: SparkSession, counts: DataFrame, keys: list[str], mode: str) -> DataFrame:
    """The last version of each row of a running aggregate; what the stream wrote is deleted."""
    out = scratch(spark, "stream")

    def sink(batch: DataFrame, epoch: int) -> None:
        # overwriting the folder of the epoch makes a repeated batch harmless
        batch.write.mode("overwrite").parquet(f"{out}/state/epoch={epoch}")

    query = (counts.writeStream.outputMode(mode).foreachBatch(sink)
             .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    state = spark.read.parquet(f"{out}/state")
    last = cut_lineage(state.groupBy(*keys).agg(F.max_by("pulls", "epoch").alias("pulls"), F.max_by("wins", "epoch").alias("wins")))
    discard(spark, out)
    return last


def stream_arm_posteriors(spark: SparkSession, src_dir: str, lateness: str | None = None,
                          files_per_trigger: int = 1000) -> DataFrame:
    """Incremental Beta posteriors per arm; returns the final state table."""
    s = event_stream(spark, src_dir, lateness=lateness, files_per_trigger=files_per_trigger)
    counts = s.groupBy("arm").agg(F.sum("reward").cast("long").alias("wins"), F.count("*").alias("pulls"))
    st = _run(spark, counts, ["arm"], "update")
    return st.select("arm", "pulls", (F.col("wins") + 1).alias("alpha"),
                     (F.col("pulls") - F.col("wins") + 1).alias("beta")).withColumn(
        "mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))


def stream_daily_arm_counts(spark: SparkSession, src_dir: str, window: str = "1 day", lateness: str | None = None,
                            files_per_trigger: int = 1000) -> DataFrame:
    """B4 (stream part): pulls and wins per (tumbling day, arm).

    Update mode: every micro-batch writes the windows it changed; the latest version of each window is
    the answer, so days still open when the input ends are reported too.
    """
    s = event_stream(spark, src_dir, lateness=lateness, files_per_trigger=files_per_trigger)
    counts = s.groupBy(F.window("ts", window).alias("w"), "arm").agg(
        F.count("*").alias("pulls"), F.sum("reward").cast("long").alias("wins"))
    return _run(spark, counts.select(F.col("w.start").alias("day"), "arm", "pulls", "wins"), ["day", "arm"], "update")


def daily_share(counts: DataFrame, threshold: float, length: int) -> DataFrame:
    """B4 (state part): each arm's share of a day's pulls and whether it has stayed above
    ``threshold`` for ``length`` consecutive days (converged)."""
    from pyspark.sql import Window

    w_day = Window.partitionBy("day")
    x = counts.withColumn("share", F.col("pulls") / F.sum("pulls").over(w_day))
    w = Window.partitionBy("arm").orderBy("day").rowsBetween(-(length - 1), 0)
    return x.withColumn("converged", (F.min((F.col("share") > threshold).cast("int")).over(w) == 1)
                        & (F.count("*").over(w) == length))
