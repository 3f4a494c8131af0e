"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.llm.common import in_runs, row_key, running_totals, unit, WORD
from lodestar.session import cut_lineage

#: Words of a block.
BLOCK = 256
WEIGHTS = (5.0, 2.0, 1.0)
#: Times a document may be read at most.
PASSES = 3
#: Sources up to this number are broadcast; more are joined by a shuffle.
FEW = 2_000


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(source, weight, source_size, target): shares of the sum of all sizes, by source.

    Sources in code point order, null last, take the weights in turn.  A target stops at ``passes``
    times its source's size and the excess is shared again by weight until no target is above.  That
    ends where target = least(passes * size, level * weight) with one level for all, so sources sorted
    by passes * size / weight give the level directly: the first source whose ratio is not under the
    level of itself and all later ones sets it.  One row of each source is all that a task sees.
    """
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    s = s.withColumn("cap", F.lit(float(passes)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
    s = s.withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return s.select("source", "weight", "source_size", target.alias("target"))


def plan(rows: DataFrame, weights: tuple[float, ...], passes: int, block: int) -> DataFrame:
    """``targets`` with the whole words to take (``words``), blocks (``blocks``) and earlier blocks (``first``)."""
    t = targets(rows, weights, passes).withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
    t = t.withColumn("blocks", F.ceil(F.col("words") / F.lit(block)).cast("long"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return (t.withColumn("index", F.row_number().over(order).cast("long"))
            .withColumn("first", F.coalesce(F.sum("blocks").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))


def golden_step(n: int) -> int:
    """The step of the golden-ratio lattice on n points: the number nearest n / phi that shares no factor with n."""
    near = int((math.isqrt(5 * n * n) - n) // 2)
    for d in range(n + 1):
        for step in (near + d, near - d):
            if 0 < step <= n and math.gcd(step, n) == 1:
                return step
    return 1


def schedule(sources: DataFrame, n: int, small: bool) -> DataFrame:
    """(index, rank, slot): slot j of n belongs to the source whose interval of cumulative blocks holds point j.

    The points are the golden-ratio lattice j * step mod n, which meets every integer once, so each
    source gets exactly its blocks, spread with low discrepancy.  The slots of a source are the
    lattice's inverse on its interval, which needs no search; they are ranked by slot.
    """
    back = pow(golden_step(n), -1, n) if n > 1 else 0
    runs = sources.where("blocks > 0").withColumn("_run", F.explode(F.expr("sequence(0L, (blocks - 1) div 4096)")))
    runs = runs.repartition("index", "_run")
    points = runs.withColumn("_x", F.explode(F.expr("sequence(first + _run * 4096, first + least(blocks, (_run + 1) * 4096) - 1)")))
    big = "decimal(19,0)"
    slots = points.select("index", F.pmod(F.col("_x").cast(big) * F.lit(back).cast(big), F.lit(n).cast(big)).cast("long").alias("slot"))
    return running_totals(slots, ["index"], F.col("slot") / F.lit(float(n)), ["slot"], F.lit(1), "rank", small)


def mix(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = PASSES, block: int = BLOCK,
        seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The mix of ``rows`` (key columns, ``source``, ``size``): (sources, pieces).

    ``pieces`` has one row for each stretch of a document that a slot takes: ``slot``, the key columns,
    ``source``, ``size``, ``copy`` (which of equal rows), ``pass``, ``from_word`` and ``words``; in the
    order of ``slot`` and ``at`` it is the mixed corpus.  A row without words, or one that the mix does
    not reach, has one piece with null slot and 0 words, so every row is there.

    The documents of a source, shuffled by a seeded hash, form a stream that is read at most
    ``passes`` times and cut into blocks of ``block`` words; block r of a source goes to the slot of
    rank r.  The last block of a source is cut where its target is met.  Null sources are one source.
    """
    keys = [c for c in rows.columns if c not in ("source", "size")]
    rows = cut_lineage(rows)  # counting the words is most of the work, and four steps need the counts
    sources = cut_lineage(plan(rows, weights, passes, block))
    n, n_sources = sources.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.count(F.lit(1))).first()
    small = n_sources <= FEW
    dim = F.broadcast(sources) if small else sources
    same = rows.groupBy("source", "size", *keys).agg(F.count(F.lit(1)).alias("copies"))
    d = same.alias("d").join(dim.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).drop(F.col("s.source"))
    named = [F.col(f"`{k}`") for k in keys]
    d = d.withColumn("_hash", F.xxhash64(F.lit(seed), F.col("size"), *named, *[F.when(c.isNull(), i).otherwise(-1) for i, c in enumerate(named)]))
    d = running_totals(d.withColumn("_at", unit(F.col("_hash"))), ["index"], F.col("_at"), ["_at", "_hash", "size", *keys],
                       F.col("size") * F.col("copies"), "start", small)
    d = in_runs(d, F.col("copies"), "copy").withColumn("start", F.expr("start + copy * size"))
    d = d.withColumn("pass", F.explode_outer(F.expr(
        f"IF(size > 0 AND start < words, sequence(0L, least({passes} - 1L, (words - 1 - start) div source_size)), NULL)")))
    d = d.withColumn("lo", F.expr("start + pass * source_size")).withColumn("hi", F.expr("least(lo + size, words)"))
    d = d.withColumn("block", F.explode_outer(F.expr(f"IF(pass IS NULL, NULL, sequence(lo div {block}, (hi - 1) div {block}))")))
    slots = schedule(sources, int(n), small).withColumnRenamed("index", "_index") if n else None
    if slots is None:
        d = d.withColumn("slot", F.lit(None).cast("long"))
    else:
        d = d.join(slots.select("_index", "rank", "slot").hint("merge"), (F.col("index") == F.col("_index")) & (F.col("block") == F.col("rank")), "left")
    a, b = F.greatest("lo", F.col("block") * block), F.least("hi", (F.col("block") + 1) * block)
    pieces = d.select("slot", F.greatest("lo", F.col("block") * block).alias("at"), *named, "source", "size", "source_size", "target",
                      "copy", "pass", (a - F.col("lo")).alias("from_word"), F.when(F.col("slot").isNull(), 0).otherwise(b - a).cast("long").alias("words"))
    return sources, pieces


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = PASSES, block: int = BLOCK,
                    seed: int = 0, text: str = "text", id_col: str = "doc_id", source: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken, source) of every document: the words that the mix takes of it, repeats counted.

    ``size`` is the number of words (null text: 0).  ``target`` and ``source_size`` belong to the
    document's source.  Rows with equal id, source and size stay separate result rows.  Documents
    without words have taken 0; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    _, pieces = mix(rows, weights, passes, block, seed)
    return (pieces.groupBy("source", "_id", "size", "copy")
            .agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum("words").alias("taken"))
            .select(F.col("_id").alias(id_col), "size", "source_size", "target", "taken", F.col("source")))


def mixed_copies(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = PASSES, block: int = BLOCK,
                 seed: int = 0, text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` as whole documents in the proportions of the mix, with all their columns.

    A document appears once for each pass in which the mix takes at least half of its words, so a
    source's words come within about one document of its target; documents that the mix does not
    reach, or that have no words, do not appear.  Equal rows are counted, and each copy is decided
    on its own.
    """
    k1, k2 = row_key(docs)
    # a row travels as one struct, so its columns may have any names
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), k1.alias("_k1"), k2.alias("_k2"))
    rows = docs.select(k1.alias("_k1"), k2.alias("_k2"), F.col(f"`{source}`").alias("source"), n_words(F.col(f"`{text}`")).alias("size"))
    _, pieces = mix(rows, weights, passes, block, seed)
    taken = pieces.where("words > 0").groupBy("_k1", "_k2", "copy", "pass").agg(F.sum("words").alias("words"), F.first("size").alias("size"))
    times = taken.where("2 * words >= size").groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("_times"))
    one = keyed.join(times.hint("merge"), ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])
    return in_runs(one.select("row", "_times"), F.col("_times"), "_time").select("row.*")
