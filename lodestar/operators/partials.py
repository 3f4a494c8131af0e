"""Sums of large arrays over all rows: one partial for each task, merged by a tree.

A task reduces its rows to named arrays and writes each as chunks of at most ``CHUNK`` numbers.  Chunks
with one number and name are added up ``FAN_IN`` at a time, level by level, so neither the rows of a
shuffle nor what one task holds grow with the size of the arrays times the number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers in one chunk, and chunks that are added up at a time.
CHUNK, FAN_IN = 1 << 15, 32
_SCHEMA = "name string, chunk int, part long, total array<double>"


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of number lists of one length as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, -1) if n else np.zeros((0, 0))


def lists(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as a column of lists."""
    x = np.ascontiguousarray(x, dtype=np.float64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], type=pa.int32()), pa.array(x.ravel()))


def _batch(rows: list[tuple[str, int, int, np.ndarray]]) -> pa.RecordBatch:
    names, chunks, parts, totals = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(chunks, pa.int32()), pa.array(parts, pa.int64()), pa.array(totals, pa.list_(pa.float64()))],
        names=["name", "chunk", "part", "total"])


def merged(df: DataFrame, reduce: Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]],
           merge: Callable[[list[np.ndarray]], np.ndarray] | None = None, whole: bool = False) -> DataFrame:
    """(name, chunk, part, total): what ``reduce`` makes of every task's batches, added up over the tasks.

    ``reduce`` returns named arrays; arrays of one name have one size in every task.  ``merge`` replaces the sum
    of a few arrays; it must not depend on their order.  With one, or with ``whole``, arrays are not cut into chunks.
    """

    def partial(batches):
        part = TaskContext.get().partitionId()
        for name, values in reduce(batches).items():
            flat = np.asarray(values, dtype=np.float64).ravel()
            step = max(len(flat), 1) if merge or whole else CHUNK
            for c, at in enumerate(range(0, max(len(flat), 1), step)):
                yield _batch([(name, c, part, flat[at:at + step])])

    def add(table: pa.Table) -> pa.Table:
        values = [c.values.to_numpy(zero_copy_only=False) for c in table.column("total")]
        total = merge(values) if merge else np.sum(values, axis=0)
        name, chunk, part = (table.column(c)[0].as_py() for c in ("name", "chunk", "part"))
        return pa.Table.from_batches([_batch([(name, chunk, part, total)])])

    parts = df.mapInArrow(partial, _SCHEMA)
    tasks = df.rdd.getNumPartitions()
    while tasks > 1:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long")).groupBy("name", "chunk", "part").applyInArrow(add, _SCHEMA)
        tasks = -(-tasks // FAN_IN)
    return parts


def array_sums(df: DataFrame, reduce: Callable[[Iterator[pa.RecordBatch]], dict[str, np.ndarray]],
               merge: Callable[[list[np.ndarray]], np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """``merged`` on the driver, for arrays of a model's size: flat arrays by name."""
    found: dict[str, list] = {}
    for name, chunk, _, total in merged(df, reduce, merge).collect():  # one row for each chunk
        found.setdefault(name, []).append((chunk, total))
    return {name: np.concatenate([np.asarray(t, dtype=float) for _, t in sorted(cs, key=lambda c: c[0])]) for name, cs in found.items()}
