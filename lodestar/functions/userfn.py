"""User-function surface (X1, X5): shared-argument maps and row generators.  X3, a kernel of the user's own, is an
argument of ``similarity.kernel_block_sum``."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_with_broadcast(df: DataFrame, fn: Callable[[pd.DataFrame, object], pd.DataFrame], shared: object,
                       schema: str) -> DataFrame:
    """Apply ``fn(batch, shared)`` to Arrow batches; ``shared`` travels once per task with the closure
    (use a broadcast variable for large values)."""
    sc = df.sparkSession.sparkContext
    bc = sc.broadcast(shared)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        value = bc.value
        for pdf in it:
            yield fn(pdf, value)

    return df.mapInPandas(run, schema)


def explode_boxes(df: DataFrame, boxes: str, out: Sequence[str] = ("x", "y", "w", "h")) -> DataFrame:
    """One row for each box of an image's box list, with its position from 0; images without boxes give none."""
    return df.select(*[c for c in df.columns if c != boxes], F.posexplode(boxes).alias("box_no", "_b")).select(
        *[c for c in df.columns if c != boxes], "box_no", *[F.col(f"_b.{c}").alias(c) for c in out])
