"""Run-length state per arm (B4): the first run of days on which an arm's share stays above a threshold.

Two queries hand over through files.  The first counts events per (day, arm) and, in every micro-batch, writes
the days it changed with the number of the batch.  The second keeps, for each arm, the days that may still
change and a summary of those that cannot; a newer count of a day replaces the older one, so events may come in
any order.  With a bound on lateness a timer closes each day: its flag is folded into the summary and leaves
the state, which then holds a bounded number of days.  Without one every day stays open and nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lodestar.session import cut_lineage, discard, scratch
from lodestar.streaming.bandit import event_stream

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DAY_MS = 86_400_000

OUTPUT = "arm string, version long, run_start int, reached int, current int"


def follow(start: int | None, last: int | None, found: tuple[int, int] | None, days: list[tuple[int, bool]], length: int):
    """(start of the open run, its last day, (start, day reached) of the first run of ``length`` days) after more days in order."""
    for day, above in days:
        if not above:
            start = None
        elif start is None or day != last + 1:
            start = day
        last = day
        if above and found is None and day - start + 1 >= length:
            found = (start, day)
    return start, last, found


class RunLengths(StatefulProcessor):
    """State of one arm: open days with the version of their count, and the summary of closed ones."""

    def __init__(self, threshold: float, length: int, lateness_days: int | None):
        self.threshold, self.length, self.lateness_days = threshold, length, lateness_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "day int", "version long, above boolean")
        self.closed = handle.getValueState("closed", "start int, last int, found_start int, found_day int")

    def _summary(self):
        held = self.closed.get() if self.closed.exists() else (None, None, None, None)
        start, last, found_start, found_day = held
        return start, last, None if found_start is None else (found_start, found_day)

    def _answer(self, arm: str, version: int) -> pd.DataFrame:
        days = sorted((key[0], value[1]) for key, value in self.open.iterator())
        start, last, found = follow(*self._summary(), days, self.length)
        row = (arm, version, *(found or (None, None)), None if start is None else last - start + 1)
        return pd.DataFrame([row], columns=[f.split()[0] for f in OUTPUT.split(", ")]).astype(
            {"run_start": "Int32", "reached": "Int32", "current": "Int32"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        version = -1
        _, closed_to, _ = self._summary()
        for pdf in rows:
            for day, batch, share in zip(pdf["day"].tolist(), pdf["version"].tolist(), pdf["share"].tolist()):
                version = max(version, batch)
                if closed_to is not None and day <= closed_to:
                    continue  # the caller's bound on lateness has passed
                held = self.open.getValue((day,)) if self.open.containsKey((day,)) else None
                if held is None and self.lateness_days is not None:
                    self.handle.registerTimer((day + 1 + self.lateness_days) * _DAY_MS)
                if held is None or held[0] <= batch:
                    self.open.updateValue((day,), (batch, share > self.threshold))
        yield self._answer(key[0], version)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = expiredTimerInfo.getExpiryTimeInMs() // _DAY_MS - 1 - self.lateness_days
        days = sorted((k[0], v[1]) for k, v in self.open.iterator() if k[0] <= upto)
        start, last, found = follow(*self._summary(), days, self.length)
        if last is not None:
            self.closed.update((start, last, *(found or (None, None))))
        for day, _ in days:
            self.open.removeKey((day,))
        yield from ()

    def close(self) -> None:
        pass


def stream_stable_runs(spark: SparkSession, src_dir: str, threshold: float, length: int, lateness_days: int | None = None,
                       files_per_trigger: int = 1000) -> DataFrame:
    """(arm, run_start, reached, current): for each arm the first run of ``length`` consecutive days (numbers since 1970) with a share
    of the day's events above ``threshold``, the day on which it reached that length, and how long the arm's last run is.

    A day on which an arm has no event has share 0; a day without any event ends every run.
    """
    out = scratch(spark, "runs")
    lateness = None if lateness_days is None else f"{lateness_days} days"
    events = event_stream(spark, src_dir, lateness=lateness, files_per_trigger=files_per_trigger)
    counts = events.groupBy(F.window("ts", "1 day").alias("w"), "arm").agg(F.count(F.lit(1)).alias("pulls"))

    def keep(batch: DataFrame, epoch: int) -> None:
        """Write the changed counts, then the shares of all arms on the changed days; a repeated batch writes the same folders again."""
        changed = batch.select(F.unix_date(F.to_date("w.start")).alias("day"), "arm", "pulls")
        changed.write.mode("overwrite").partitionBy("day").parquet(f"{out}/counts/batch={epoch}")
        held = spark.read.schema("arm string, pulls long, batch long, day int").parquet(f"{out}/counts").where(F.col("batch") <= epoch)
        own = held.where(F.col("batch") == epoch).select("day").distinct()
        latest = held.join(own, "day", "left_semi").groupBy("day", "arm").agg(F.max_by("pulls", "batch").alias("pulls"))
        total = latest.groupBy("day").agg(F.sum("pulls").alias("total"))
        shares = latest.join(total, "day").select("arm", "day", F.lit(epoch).cast("long").alias("version"), (F.col("pulls") / F.col("total")).alias("share"))
        shares.write.mode("overwrite").parquet(f"{out}/shares/batch-{epoch}")

    counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{out}/first").trigger(availableNow=True).start().awaitTermination()

    shares = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/shares")
    if not shares.getFileSystem(spark._jsc.hadoopConfiguration()).exists(shares):  # there were no events
        discard(spark, out)
        return spark.createDataFrame([], "arm string, run_start int, reached int, current int")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    try:
        source = spark.readStream.schema("arm string, day int, version long, share double").option("maxFilesPerTrigger", files_per_trigger).parquet(
            f"{out}/shares/batch-*")
        timed = source.withColumn("at", F.timestamp_seconds(F.col("day") * 86400.0))
        if lateness_days is not None:
            timed = timed.withWatermark("at", f"{lateness_days} days")
        runs = timed.groupBy("arm").transformWithStateInPandas(
            RunLengths(threshold, length, lateness_days), OUTPUT, "Update", "None" if lateness_days is None else "EventTime")

        def answer(batch: DataFrame, epoch: int) -> None:
            batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{out}/runs/batch={epoch}")

        runs.writeStream.outputMode("update").foreachBatch(answer).option("checkpointLocation", f"{out}/second").trigger(
            availableNow=True).start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    last = spark.read.parquet(f"{out}/runs").groupBy("arm").agg(F.max_by(F.struct("run_start", "reached", "current"), "epoch").alias("r"))
    done = cut_lineage(last.select("arm", "r.*"))
    discard(spark, out)
    return done
