"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: White space between words; every other byte belongs to a word.
SPACE = b" \t\n\x0b\x0c\r"
#: The same as a regular expression over characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of one slice when a long text is read word by word.
SLICE_BYTES = 1 << 20

_gap = re.compile(rb"[\x20\x09-\x0d]")


def word_slices(data: bytes, size: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The words of ``data`` in lists of about ``size`` bytes, so that a huge text never becomes one huge list."""
    at = 0
    while at < len(data):
        cut = _gap.search(data, at + size) if at + size < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


#: Rows that an Arrow function works on at a time; Spark hands over ten times as many.
SUB_ROWS = 1024


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``SUB_ROWS`` rows.

    A worker takes its buffers from the system and gives them back, where Arrow's own pool would keep
    the largest it ever needed.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        for at in range(0, batch.num_rows, SUB_ROWS):
            yield batch.slice(at, SUB_ROWS)


def map_batches(df: DataFrame, schema: T.StructType | str, make: Callable[[], Callable[[pa.RecordBatch], dict | None]],
                ) -> DataFrame:
    """``mapInArrow`` with a per-task set-up: ``make()`` builds the function that turns a batch into columns.

    The function returns a dict of column values (or None for no rows); types come from ``schema``.
    """
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        one = make()
        for batch in slices(batches):
            made = one(batch)
            if made is not None:
                yield pa.RecordBatch.from_arrays(
                    [made[f.name].cast(f.type) if isinstance(made[f.name], (pa.Array, pa.ChunkedArray))
                     else pa.array(made[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def row_key(df: DataFrame) -> tuple[Column, Column]:
    """A 128-bit hash of a whole row; equal rows, and only they, share it."""
    named = [(F.col(f"`{f.name}`"), f.dataType.simpleString()) for f in df.schema.fields]
    cols = [F.to_json(F.struct(c)) if "map<" in kind else c for c, kind in named]  # maps have no hash of their own
    nulls = [F.when(c.isNull(), i).otherwise(-1) for i, c in enumerate(cols)]
    return F.xxhash64(*cols, *nulls), F.xxhash64(F.lit("second"), *nulls, *cols)


def unit(h: Column) -> Column:
    """A 64-bit hash as a fraction in [0, 1), rising with the unsigned hash."""
    top = F.shiftrightunsigned(h, 11).cast("double")
    return top / F.lit(float(1 << 53))


def running_totals(df: DataFrame, group: list[str], place: Column, order: list[str], value: Column, name: str,
                   small_groups: bool = False) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same group that come earlier.

    ``place`` in [0, 1) rises with ``order`` inside a group.  A group of n rows is cut into about
    sqrt(n) ranges of ``place``; sums of ranges are added up first, then the rows of each range.
    Neither step sees more than about sqrt(n) rows of a group together, so a group with a third of
    all rows stays spread.  ``small_groups`` says that the caller has checked that the groups are
    few enough to broadcast one row of each.
    """
    d = df.withColumn("_place", place).withColumn("_value", value)
    if group:
        counts = d.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
        d = d.join(F.broadcast(counts) if small_groups else counts, group)
    else:
        d = d.withColumn("_n", F.lit(int(df.count())))
    d = d.withColumn("_range", F.floor(F.col("_place") * F.ceil(F.sqrt("_n"))).cast("long")).drop("_n", "_place")
    key = [*group, "_range"]
    sums = d.groupBy(*key).agg(F.sum("_value").alias("_sum"))
    upto = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*key, F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # the planner does not see how far rows were exploded, so it must not think of a broadcast here
    return (d.join(sums.hint("merge"), key)
            .withColumn(name, F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
            .drop("_offset", "_value", "_range"))


#: Copies of one row that leave a task as one list.
RUN = 1024


def in_runs(df: DataFrame, count: Column, name: str) -> DataFrame:
    """``count`` copies of every row, numbered from 0 in ``name``, never more than ``RUN`` of them in one list."""
    runs = df.withColumn("_copies", count.cast("long")).withColumn("_run", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {RUN})")))
    return runs.withColumn(name, F.explode(F.expr(f"sequence(_run * {RUN}, least(_run * {RUN} + {RUN - 1}, _copies - 1))"))).drop("_copies", "_run")
