"""Bounded samples of labelled rows, shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: tuple[int, int], seed: int = 0) -> DataFrame:
    """(_text, _label) of at most ``rows`` (of class 0, of class 1) labelled documents among those that ``learn`` admits.

    ``learn`` is a condition on ``_id``.  The ids are the first in the order of a seeded hash, so the
    choice neither depends on partitions nor takes a prefix of the table.  An id with several labels
    takes the largest.  The bound holds for documents too: an id that repeats in ``docs`` gives one
    row, the one whose text has the smallest hash.
    """
    marks = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
             .where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & learn)
             .groupBy("_id").agg(F.max("_label").alias("_label")))
    order = F.xxhash64(F.lit(seed), "_id")
    some = marks.where("_label = 0").orderBy(order, "_id").limit(rows[0]).union(
        marks.where("_label = 1").orderBy(order, "_id").limit(rows[1]))
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    first = F.min(F.struct(F.xxhash64("_text").alias("h"), F.col("_text")))
    return (texts.join(F.broadcast(some), "_id").groupBy("_id", "_label").agg(first.alias("_first"))
            .select("_id", F.col("_first._text").alias("_text"), "_label"))
