"""Distributed running totals for orderings that have no partition key.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task, and a hot group does
the same with one.  Here rows are dealt out into ranges of the whole order (group columns first, then
every order column), each range is scanned by its own task, and the totals of the earlier ranges of
the group are added as an offset.  Ranges are cut on the composite key, so many equal first keys
still spread; any sortable type and nulls are kept, in Spark's sort order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.session import cut_lineage

_RB = "_range_id"


def _order_cols(order_by: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order_by]


def default_ranges(df: DataFrame) -> int:
    """One range per shuffle partition — scales with the cluster's setting."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def with_range_id(df: DataFrame, order_by: Sequence[tuple[str, bool]], partition_by: Sequence[str] = (),
                  n_ranges: int | None = None) -> DataFrame:
    """Add ``_range_id``: ranges of (group, order) numbered in sort order.

    The rows are written down once with their range, in the shared checkpoint folder: cut points come
    from a sample, and another evaluation could draw other ones.
    """
    n = n_ranges or default_ranges(df)
    keys = [F.col(c).asc() for c in partition_by] + _order_cols(order_by)
    return cut_lineage(df.repartitionByRange(n, *keys).withColumn(_RB, F.spark_partition_id()))


def running_totals(
    df: DataFrame,
    order_by: Sequence[tuple[str, bool]],
    sums: Mapping[str, Column],
    partition_by: Sequence[str] = (),
    n_ranges: int | None = None,
    exclusive: bool = False,
    how: str = "sum",
) -> DataFrame:
    """Add one running-sum column per entry of ``sums`` (cumulative in ``order_by``).

    ``order_by`` is a list of ``(column, ascending)`` of any sortable type; nulls come first when
    ascending and last when descending.  ``exclusive=True`` sums strictly earlier rows.
    ``how="max"`` gives running maxima instead of sums.
    """
    agg = F.sum if how == "sum" else F.max
    ranged = df
    for name, expr in sums.items():
        ranged = ranged.withColumn(f"_v_{name}", expr)
    ranged = with_range_id(ranged, order_by, partition_by, n_ranges)
    parts = [*partition_by, _RB]
    totals = ranged.groupBy(*parts).agg(*[agg(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*partition_by).orderBy(_RB).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_k_{c}") for c in parts],
        *[(F.coalesce(agg(f"_t_{n}").over(before), F.lit(0)) if how == "sum" else agg(f"_t_{n}").over(before)).alias(f"_o_{n}")
          for n in sums],
    )
    same = F.lit(True)
    for c in parts:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    joined = ranged.join(offsets, same)
    upto = -1 if exclusive else 0
    w = Window.partitionBy(*parts).orderBy(*_order_cols(order_by)).rowsBetween(Window.unboundedPreceding, upto)
    for n in sums:
        if how == "sum":
            joined = joined.withColumn(n, F.col(f"_o_{n}") + F.coalesce(F.sum(f"_v_{n}").over(w), F.lit(0)))
        else:
            joined = joined.withColumn(n, F.greatest(F.col(f"_o_{n}"), F.max(f"_v_{n}").over(w)))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c not in sums], *sums)


def global_row_number(df: DataFrame, order_by: Sequence[tuple[str, bool]], name: str = "step",
                      n_ranges: int | None = None) -> DataFrame:
    """1-based position in a total order, computed range by range."""
    out = running_totals(df, order_by, {name: F.lit(1).cast("long")}, n_ranges=n_ranges)
    return out.withColumn(name, F.col(name).cast("long"))


def grouped_row_number(df: DataFrame, by: Sequence[str], order_by: Sequence[tuple[str, bool]], name: str,
                       n_ranges: int | None = None) -> DataFrame:
    """1-based position inside each group, computed range by range, so a group with most rows is spread."""
    return running_totals(df, order_by, {name: F.lit(1).cast("long")}, partition_by=list(by), n_ranges=n_ranges)
