"""Writers (K1, K2, K4, K5; K3 lives with the LSH index)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_model(weights: DataFrame, path: str) -> None:
    """K1: weights as (model_id, layer, i, values) partitioned by model."""
    weights.write.mode("overwrite").partitionBy("model_id").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """K2: a metric table as CSV with a header (one file per partition, no single-writer funnel)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def append_metrics(history: DataFrame, path: str) -> None:
    """K4: append (model_id, step, metric, value) rows to the history table; a retry may append them again."""
    history.write.mode("append").partitionBy("model_id").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The history with each (model_id, step, metric) once, so rows that a retry appended again do not count."""
    return spark.read.parquet(path).dropDuplicates(["model_id", "step", "metric"])


def write_training_set(df: DataFrame, path: str) -> None:
    """K5: labelled proposals partitioned by (split, category_id) for pruned reads."""
    df.write.mode("overwrite").partitionBy("split", "category_id").parquet(path)
