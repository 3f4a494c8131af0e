"""Inputs derived from the supplied tables (FIXTURES.md §4).

Each builder has a SQL twin with the same expression so that the DuckDB
oracle sees exactly the rows Spark sees.  Every builder reads whole tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.session import table

IMG_W, IMG_H = 640, 480
LSH_TABLES, LSH_HASHES, LSH_R, LSH_DIM = 10, 4, 0.5, 64


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings → (vec_id, label, v array<double>)."""
    e = table(spark, sf, "embeddings").where(F.col("embedding").isNotNull())
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


VECTORS_SQL = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL"


def boxes(spark: SparkSession, sf: str, deal: Sequence[str] = ()) -> DataFrame:
    """lineitem → one box per distinct (order, part, supplier, line, quantity).

    Only that key is moved; all else is made from it afterwards.  With ``deal`` rows are dealt out by these columns (of
    img_id, category_id) before equal ones are dropped, so joins and groups on them need not move the boxes again.
    """
    li = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("img_id"), "l_partkey", "l_suppkey", "l_linenumber",
        (F.lit(50) + F.col("l_quantity")).cast("int").alias("w"), (F.col("l_suppkey") % 18).cast("int").alias("category_id"))
    return (li.repartition(*deal) if deal else li).distinct().select(
        "img_id", "l_partkey", "l_suppkey", "l_linenumber",
        (F.col("l_partkey") % 40).cast("int").alias("x"),
        (F.col("l_suppkey") % 40).cast("int").alias("y"),
        "w",
        (F.lit(60) + F.lit(5) * F.col("l_linenumber")).cast("int").alias("h"),
        "category_id",
        F.concat_ws("-", "img_id", "l_partkey", "l_suppkey", "l_linenumber", "w").alias("box_id"),  # the natural key as text
    )


BOXES_SQL = """SELECT DISTINCT l_orderkey AS img_id, l_partkey, l_suppkey, l_linenumber,
  CAST(l_partkey % 40 AS INTEGER) AS x, CAST(l_suppkey % 40 AS INTEGER) AS y,
  CAST(50 + l_quantity AS INTEGER) AS w, CAST(60 + 5 * l_linenumber AS INTEGER) AS h,
  CAST(l_suppkey % 18 AS INTEGER) AS category_id
FROM lineitem"""


def truth_and_proposals(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    b = boxes(spark, sf, ["img_id", "category_id"])
    return b.where(F.col("l_linenumber") == 1), b.where(F.col("l_linenumber") != 1)


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Which part follows which in an order: part → part of the next line, over all lineitem rows.

    Lines are ordered by number, then part, supplier and quantity; the last line of an order has no
    edge.  cost = 1 + (number of times mod 97), cap = quantity on the first of the two lines.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    j = li.select(F.col("l_partkey").alias("src"), F.lead("l_partkey").over(w).alias("dst"), "l_quantity")
    return j.where(F.col("dst").isNotNull()).groupBy("src", "dst").agg(
        (F.lit(1) + F.count("*") % 97).cast("long").alias("cost"),
        F.sum("l_quantity").alias("cap"),
    )


EDGES_SQL = """SELECT src, dst, CAST(1 + count(*) % 97 AS BIGINT) AS cost, sum(l_quantity) AS cap
FROM (SELECT l_partkey AS src, l_quantity,
        lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS dst
      FROM lineitem) t
WHERE dst IS NOT NULL GROUP BY src, dst"""


def scored_docs(spark: SparkSession, sf: str) -> DataFrame:
    """documents ⨝ labels: score = n_chars, label = quality, toxic kept alongside."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    l = table(spark, sf, "labels")
    return d.join(l, "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("score"), F.col("quality").alias("label"),
        "toxic", "lang", "source",
    )


SCORED_SQL = """SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS score, l.quality AS label, l.toxic, d.lang, d.source
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def arms(spark: SparkSession, sf: str) -> DataFrame:
    """events as a bandit log: arm = event_type, reward = value > 50."""
    e = table(spark, sf, "events")
    return e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("arm"),
        (F.col("value") > 50).cast("int").alias("reward"),
    )


ARMS_SQL = "SELECT event_id, ts, event_type AS arm, CAST(value > 50 AS INTEGER) AS reward FROM events"


def series(spark: SparkSession, sf: str) -> DataFrame:
    """events averaged per 6-hour bucket → (t, y)."""
    e = table(spark, sf, "events")
    b = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 21600).cast("long")
    return e.groupBy(b.alias("t")).agg(F.avg("value").alias("y"), F.count("*").alias("n"))


SERIES_SQL = """SELECT CAST(floor(epoch(ts) / 21600) AS BIGINT) AS t, avg(value) AS y, count(*) AS n
FROM events GROUP BY 1"""


def plans(spark: SparkSession, sf: str, n_plans: int = 7) -> DataFrame:
    """part as a plan table: item, value, usage, plan (p_partkey mod n_plans)."""
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("item"), F.col("p_retailprice").alias("value"),
        F.col("p_size").alias("usage"), (F.col("p_partkey") % n_plans).cast("int").alias("plan"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("ptype"),
    )


PLANS_SQL = """SELECT p_partkey AS item, p_retailprice AS value, p_size AS usage,
  CAST(p_partkey % 7 AS INTEGER) AS plan, p_brand AS brand, p_type AS ptype FROM part"""


SCENARIOS_SQL = "SELECT * FROM (VALUES (0, 0.8::DOUBLE, 1.0::DOUBLE/3), (1, 1.0::DOUBLE, 1.0::DOUBLE/3), (2, 1.2::DOUBLE, 1.0::DOUBLE/3)) t(scenario, factor, prob)"


def history(spark: SparkSession, sf: str) -> DataFrame:
    """events as a training log: step (1-based, by ts then id), split by id parity, metric = value."""
    from lodestar.operators.prefix import global_row_number

    e = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"
    )
    e = global_row_number(e, [("ts", True), ("event_id", True)], "step")
    return e.select(
        "step", "event_id", "event_type",
        F.when(F.col("event_id") % 2 == 0, F.lit("train")).otherwise(F.lit("val")).alias("split"),
        F.col("value").alias("metric"),
    )


HISTORY_SQL = """SELECT row_number() OVER (ORDER BY ts, event_id) AS step, event_id, event_type,
  CASE WHEN event_id % 2 = 0 THEN 'train' ELSE 'val' END AS split, value AS metric FROM events"""
