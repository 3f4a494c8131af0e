"""Sharding by a keyed permutation of global row numbers."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches, running_totals, unit

ROUNDS = 6


def _round(half: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    """Keyed mixing of a half: multiply and shift, as 64-bit finalisers do."""
    x = half + np.uint64(key)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) & mask


def _keys(seed: int) -> list[int]:
    return [(seed * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1342543DE82EF95) % (1 << 64) for r in range(ROUNDS)]


class Permutation:
    """A Feistel network on [0, n) that walks along its cycle until it is back inside."""

    def __init__(self, n: int, seed: int):
        self.n = n
        bits = max(1, math.ceil(math.log2(max(2, n)) / 2))
        bits += (1 << 2 * bits) < n  # log2 of a huge n may have been rounded down
        self.bits, self.mask, self.keys = np.uint64(bits), np.uint64((1 << bits) - 1), _keys(seed)

    def _once(self, x: np.ndarray, forward: bool) -> np.ndarray:
        left, right = x >> self.bits, x & self.mask
        for key in self.keys if forward else reversed(self.keys):
            if forward:
                left, right = right, left ^ _round(right, key, self.mask)
            else:
                left, right = right ^ _round(left, key, self.mask), left
        return left << self.bits | right

    def _walk(self, x, forward: bool) -> np.ndarray:
        with np.errstate(over="ignore"):
            y = self._once(np.asarray(x, dtype=np.uint64), forward)
            while len(out := np.flatnonzero(y >= np.uint64(self.n))):
                y[out] = self._once(y[out], forward)
        return y

    def place(self, row) -> np.ndarray:
        """The place of each row number in the shuffled order."""
        return self._walk(row, True)

    def row(self, place) -> np.ndarray:
        """The row number at each place; the inverse of ``place``."""
        return self._walk(place, False)


def number_rows(rows: DataFrame) -> DataFrame:
    """Adds ``row``: global numbers 0 to n - 1 that depend on the rows alone, not on their files or partitions.

    Rows are ordered by a hash of their columns, then by the columns.  Equal rows are counted before
    the shuffle and numbered side by side, so one row repeated many times is no hot key.
    """
    cols = [F.col(f"`{c}`") for c in rows.columns]
    nulls = [F.when(c.isNull(), i).otherwise(-1) for i, c in enumerate(cols)]
    same = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    same = same.withColumn("_hash", F.xxhash64(*cols, *nulls)).withColumn("_at", unit(F.col("_hash")))
    same = running_totals(same, [], F.col("_at"), ["_at", "_hash", *rows.columns], F.col("_copies"), "_before")
    runs = same.withColumn("_run", F.explode(F.expr("sequence(0L, (_copies - 1) div 1024)")))
    return (runs.withColumn("_i", F.explode(F.expr("sequence(0L, least(1023L, _copies - 1 - _run * 1024))")))
            .select(*cols, (F.col("_before") + F.col("_run") * 1024 + F.col("_i")).cast("long").alias("row")))


def shard_rows(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """Adds ``row``, ``shard`` and ``slot`` to every row: place p of the shuffled order is slot p div shards of shard p mod shards.

    So shards differ by one row at most, slots have no gaps, and ``locate`` and ``Permutation.row``
    give a row's shard and slot, or the row of a slot, by computation alone.  Equal rows are
    interchangeable.  An empty table gives no rows; null columns count as values of their own.
    """
    n = rows.count()
    if not n:
        return rows.select("*", *[F.lit(0).cast(t).alias(c) for c, t in (("row", "long"), ("shard", "int"), ("slot", "long"))])
    numbered = number_rows(rows)
    schema = numbered.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).schema

    def make():
        perm = Permutation(n, seed)

        def one(batch: pa.RecordBatch):
            made = {f: batch.column(i) for i, f in enumerate(batch.schema.names)}
            p = perm.place(batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.uint64))
            return made | {"shard": (p % np.uint64(shards)).astype(np.int32), "slot": (p // np.uint64(shards)).astype(np.int64)}
        return one

    return map_batches(numbered, schema, make)


def locate(row: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a row number."""
    p = int(Permutation(n, seed).place([row])[0])
    return p % shards, p // shards


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 0, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, row) of every document.

    The law is ``rows``: numbers of rows differ by one at most.  ``size`` is the text's UTF-8 bytes
    plus 1 (null text: 1, and the CRC of no bytes); ``grown_shard`` is null, as it belongs to another
    law.  Rows with equal id and text are interchangeable.  Only small columns are shuffled, never texts.
    """
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col), (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body).cast("long").alias("text_crc32"))
    return shard_rows(rows, shards, seed).select(
        id_col, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row")
