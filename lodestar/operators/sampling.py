"""Reproducible sampling, caps, splits, folds and batches.

Every sampler orders rows by a seeded hash of a key instead of an unseeded
random draw (D20), so reruns — and task retries after an executor loss —
pick the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: ``hash_order`` takes values below this.
HASH_MOD = 1 << 60
#: Leading bits of a hash that ``negative_ratio_sample`` counts by, and classes whose cuts may be broadcast.
CAP_BITS, FEW_CLASSES = 8, 2000


def hash_order(key: Column | str, seed: int = 0) -> Column:
    """Seeded pseudo-random order of any key: the first 60 bits of MD5 over "seed:key".

    Any SQL engine can repeat it, every seed gives another order, and no key overflows.
    A null key counts as the text "null".
    """
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def hash_order_sql(key: str, seed: int = 0) -> str:
    """``hash_order`` in the oracle's dialect."""
    return f"CAST('0x' || substr(md5('{seed}:' || coalesce(CAST({key} AS VARCHAR), 'null')), 1, 15) AS BIGINT)"


def cap_per_class(df: DataFrame, cls: str, key: str, caps: Mapping | int, seed: int = 0) -> DataFrame:
    """At most ``cap`` rows per class, without replacement, in seeded hash order.

    One cap for all plans as a WindowGroupLimit, so each task keeps at most ``cap`` rows per class before
    the shuffle.  Caps by class number the rows of a class range by range, so no class is one task.
    """
    if isinstance(caps, int):
        w = Window.partitionBy(cls).orderBy(hash_order(key, seed), F.col(key))
        return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= caps).drop("_r")
    from lodestar.operators.prefix import grouped_row_number

    cap = F.coalesce(F.element_at(F.create_map(*[x for kv in caps.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]), F.col(cls)), F.lit(0))
    ranked = grouped_row_number(df.withColumn("_h", hash_order(key, seed)), [cls], [("_h", True), (key, True)], "_r")
    return ranked.where(F.col("_r") <= cap).drop("_r", "_h")


def split_train_test(df: DataFrame, key: str, test_size: float, seed: int = 0) -> DataFrame:
    """``split`` = test for a seeded hash share of ``test_size``."""
    u = hash_order(key, seed) / F.lit(float(HASH_MOD))
    return df.withColumn("split", F.when(u < test_size, F.lit("test")).otherwise(F.lit("train")))


def given_split(df: DataFrame, indicator: DataFrame, key: str, flag: str, train_value=0) -> DataFrame:
    """T4: split from an external indicator column joined on the row id."""
    j = df.join(indicator.select(key, flag), key)
    return j.withColumn("split", F.when(F.col(flag) == train_value, F.lit("train")).otherwise(F.lit("test")))


def negative_ratio_sample(neg: DataFrame, pos_counts: DataFrame, cls: str, key: str, ratio: float, seed: int = 0,
                          ties: Sequence[str] = ()) -> DataFrame:
    """T5: per class keep at most ``ratio × positives`` negatives (seeded hash order, then ``key`` and ``ties``).

    Negatives are counted by class and leading bits of their hash.  All below the bin in which a class reaches its cap are
    kept where they are; only that bin's rows are numbered, range by range, so neither the majority class nor
    its sample is moved.  ``neg`` is read three times: write it down before where it is dear to make.
    """
    from lodestar.operators.prefix import grouped_row_number
    from lodestar.session import cut_lineage

    columns = [cls, *[c for c in neg.columns if c != cls]]
    n = neg.withColumn("_h", hash_order(key, seed)).withColumn("_bin", F.shiftright("_h", HASH_MOD.bit_length() - 1 - CAP_BITS).cast("int"))
    bins = n.groupBy(cls, "_bin").agg(F.count("*").alias("n")).groupBy(cls).agg(F.array_sort(F.collect_list(F.struct("_bin", "n"))).alias("_bins"))
    cap = F.floor(F.coalesce(F.col("n_pos"), F.lit(0)) * ratio).cast("long")
    start = F.struct(F.lit(None).cast("int").alias("cut"), cap.alias("room"))

    def fill(held: Column, e: Column) -> Column:
        fits = held["cut"].isNull() & (e["n"] <= held["room"])
        return F.struct(F.when(~fits, F.coalesce(held["cut"], e["_bin"])).alias("cut"),
                        F.when(fits, held["room"] - e["n"]).otherwise(held["room"]).alias("room"))

    at = pos_counts.select(cls, "n_pos").join(bins, cls).select(cls, F.aggregate("_bins", start, fill).alias("_at"))
    cuts = cut_lineage(at.select(F.col(cls).alias("_cls"), F.col("_at.cut").alias("_cut"), F.col("_at.room").alias("_room")))
    few = cuts.limit(FEW_CLASSES + 1).count() <= FEW_CLASSES  # one row for each class
    cuts = F.broadcast(cuts) if few else cuts
    mine, here = F.col(cls) == F.col("_cls"), F.col("_bin") == F.col("_cut")
    whole = n.join(cuts, mine & (F.col("_cut").isNull() | (F.col("_bin") < F.col("_cut"))))
    edge = grouped_row_number(n.join(cuts, mine & here, "left_semi"), [cls, "_bin"],
                              [("_h", True), (key, True), *((c, True) for c in ties)], "_r")
    return whole.select(*columns).unionByName(edge.join(cuts, mine & here & (F.col("_r") <= F.col("_room"))).select(*columns))


def hard_negatives(scored: DataFrame, key: str, score: str, label: str, by: Sequence[str] = (), seed: int = 0,
                   first_round: bool = False) -> DataFrame:
    """All positives + the P highest-scored negatives + P other negatives in hash order
    (first round: 2P hash-ordered negatives).  ``source`` tells which rule kept a row.

    Negatives are numbered range by range, also when ``by`` is empty or a group holds most rows.
    """
    from lodestar.operators.prefix import grouped_row_number

    by = list(by)
    p = scored.where(F.col(label) == 1)
    n = scored.where(F.col(label) == 0).withColumn("_h", hash_order(key, seed))
    if by:
        n = n.join(p.groupBy(*by).agg(F.count("*").alias("_P")), by, "left")
    else:
        n = n.withColumn("_P", F.lit(p.count()))  # one number
    n = n.withColumn("_P", F.coalesce("_P", F.lit(0)))
    drawn = [("_h", True), (key, True)]
    if first_round:
        neg = grouped_row_number(n, by, drawn, "_r").where(F.col("_r") <= 2 * F.col("_P")).withColumn("source", F.lit("random"))
    else:
        ranked = grouped_row_number(n, by, [(score, False), (key, True)], "_s")
        hard = ranked.where(F.col("_s") <= F.col("_P")).withColumn("source", F.lit("hard")).drop("_s")
        rest = grouped_row_number(ranked.where(F.col("_s") > F.col("_P")).drop("_s"), by, drawn, "_r")
        neg = hard.unionByName(rest.where(F.col("_r") <= F.col("_P")).drop("_r").withColumn("source", F.lit("random")))
    return p.withColumn("source", F.lit("positive")).unionByName(neg.drop("_h", "_P", "_r", "_s"))


def mini_batches(df: DataFrame, key: str, size: int, seed: int = 0) -> DataFrame:
    """Disjoint batches of ``size`` rows in seeded hash order (``batch_id`` from 0)."""
    from lodestar.operators.prefix import global_row_number

    x = df.withColumn("_h", hash_order(key, seed))
    x = global_row_number(x, [("_h", True), (key, True)], "_pos")
    return x.withColumn("batch_id", ((F.col("_pos") - 1) / size).cast("long")).drop("_h", "_pos")


#: Mean of one Poisson draw; larger means are sums of several.
POISSON_STEP = 8.0


def _poisson(u: Column, mean: float) -> Column:
    """A Poisson number from a uniform one, by inversion; steps run on until the last double below 1."""
    steps, term, total, k = [], math.exp(-mean), 0.0, 0
    while total + term > total:
        total += term
        steps.append(total)
        k += 1
        term *= mean / k
    return F.size(F.filter(F.array(*[F.lit(s) for s in steps]), lambda s: s <= u))


def bootstrap(df: DataFrame, key: str, fraction: float = 1.0, seed: int = 0) -> DataFrame:
    """Sample with replacement: each row appears a Poisson(``fraction``) number of times.

    The number comes from the row's seeded hash, so retries and reruns draw the same sample whatever
    the order of the rows.  The draws of one row are adjacent.  A large ``fraction`` is the sum of
    Poisson numbers of smaller mean, each from a hash of its own, so there is no upper limit.
    """
    parts = max(1, math.ceil(fraction / POISSON_STEP))
    draws = F.lit(0)
    for i in range(parts):
        own = F.col(key) if i == 0 else F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(f":{i}"))
        draws = draws + _poisson(hash_order(own, seed) / F.lit(float(HASH_MOD)), fraction / parts)
    return df.withColumn("_draws", draws).where("_draws > 0").withColumn(
        "draw", F.explode(F.sequence(F.lit(1), F.col("_draws")))).drop("_draws")


def first_n_matching(df: DataFrame, pred: Column, by: str, order: Sequence[Column], n: int) -> DataFrame:
    """Up to ``n`` rows per group among rows that satisfy ``pred``."""
    w = Window.partitionBy(by).orderBy(*order)
    return df.where(pred).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def assign_folds(df: DataFrame, n: int, order: Sequence[str], random_key: str | None = None, seed: int = 0) -> DataFrame:
    """``fold`` in 1..n — contiguous by row order, or by seeded hash when ``random_key`` is given.

    Contiguous folds come from a distributed row number: fold = ceil(pos · n / N).
    """
    from lodestar.operators.prefix import global_row_number

    if random_key is not None:
        return df.withColumn("fold", (F.pmod(hash_order(random_key, seed), F.lit(n)) + 1).cast("int"))
    total = df.count()  # one scalar
    x = global_row_number(df, [(c, True) for c in order], "_pos")
    # ntile semantics: the first (N mod n) folds get one extra row
    q, r = divmod(total, n)
    big = r * (q + 1)
    fold = F.when(F.col("_pos") <= big, F.ceil(F.col("_pos") / F.lit(q + 1))).otherwise(
        F.lit(r) + F.ceil((F.col("_pos") - big) / F.lit(max(q, 1))))
    return x.withColumn("fold", fold.cast("int")).drop("_pos")


def union_labelled(pos: DataFrame, neg: DataFrame, label: str = "label") -> DataFrame:
    """Positives then negatives with a label column."""
    return pos.withColumn(label, F.lit(1)).unionByName(neg.withColumn(label, F.lit(0)))


def difference(a: DataFrame, b: DataFrame, keep_duplicates: bool = True) -> DataFrame:
    """Multiset (``exceptAll``) or set (``subtract``) difference."""
    return a.exceptAll(b) if keep_duplicates else a.subtract(b)


def exclude(df: DataFrame, used: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in ``used`` (left anti join)."""
    return df.join(used.select(*keys), keys, "left_anti")


def sort_by(df: DataFrame, order: Sequence[tuple[str, bool]], position: str = "position") -> DataFrame:
    """Total order with a 1-based position, numbered range by range (no single-task sort)."""
    from lodestar.operators.prefix import global_row_number

    return global_row_number(df, order, position)
