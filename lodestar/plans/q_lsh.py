"""LSH index queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import lsh
from lodestar.plans import derived
from lodestar.plans.derived import LSH_DIM, LSH_HASHES, LSH_R, LSH_TABLES, VECTORS_SQL
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R, SQD
from lodestar.session import cut_lineage, discard, scratch

K = 10

_HASH_SQL = f"""v AS ({VECTORS_SQL}),
h AS (SELECT vec_id, label, v, tt.t AS table_id,
        array_to_string(list_transform(range(0, {LSH_HASHES}), lambda j: CAST(CAST(floor(list_sum(list_transform(range(0, {LSH_DIM}),
          lambda i: v[i + 1] * sin(12.9898::DOUBLE * ((tt.t * {LSH_HASHES} + j) * {LSH_DIM} + i)))) / {LSH_R}) AS BIGINT) AS VARCHAR)), ':') AS bucket
      FROM v, range(0, {LSH_TABLES}) tt(t))"""

_PAIRS_SQL = f"""{_HASH_SQL},
pt AS (SELECT a.table_id, a.vec_id AS query_id, b.vec_id AS neighbour_id, b.label, sqrt({SQD('a.v', 'b.v')}) AS distance
       FROM h a JOIN h b ON a.table_id = b.table_id AND a.bucket = b.bucket AND a.vec_id <> b.vec_id),
nb AS (SELECT query_id, neighbour_id, min(label) AS label, min(distance) AS distance FROM pt GROUP BY query_id, neighbour_id
       QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY min(distance), neighbour_id) <= {K})"""


def _index(spark: SparkSession, sf: str) -> DataFrame:
    return lsh.hash_table(derived.vectors(spark, sf), LSH_TABLES, LSH_HASHES, LSH_R, LSH_DIM)


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    """All candidates with their distances; the index holds ids alone and is written down once, as both sides read it."""
    v = derived.vectors(spark, sf)
    idx = cut_lineage(_index(spark, sf).select("table_id", "bucket", "vec_id"))
    return lsh.scored_candidates(idx, idx, v, v, K, carry=(("label", "int"),))


@register("lsh_bucket_keys", sql=f"WITH {_HASH_SQL} SELECT vec_id, CAST(table_id AS INTEGER) AS table_id, bucket FROM h")
def lsh_bucket_keys(spark: SparkSession, sf: str) -> DataFrame:
    """F10 + P11: bucket text of every vector in each of 10 tables (4 hashes, r = 0.5)."""
    return _index(spark, sf).select("vec_id", "table_id", "bucket")


@register("lsh_bucket_occupancy", sql=f"""
WITH {_HASH_SQL}, b AS (SELECT table_id, bucket, count(*) AS rows FROM h GROUP BY table_id, bucket)
SELECT CAST(table_id AS INTEGER) AS table_id, count(*) AS buckets, {R('avg(rows)')} AS mean_rows, max(rows) AS max_rows FROM b GROUP BY table_id
""")
def lsh_bucket_occupancy(spark: SparkSession, sf: str) -> DataFrame:
    """Buckets per table, mean and max rows per bucket."""
    o = lsh.bucket_occupancy(_index(spark, sf))
    return o.select("table_id", "buckets", V.rnd("mean_rows").alias("mean_rows"), "max_rows")


@register("lsh_candidate_cost", sql=f"""
WITH {_HASH_SQL}, b AS (SELECT table_id, bucket, count(*) AS rows FROM h GROUP BY table_id, bucket),
q AS (SELECT h.vec_id, sum(b.rows - 1) AS candidates FROM h JOIN b USING (table_id, bucket) GROUP BY h.vec_id)
SELECT {R('avg(candidates)')} AS mean_candidates, CAST(max(candidates) AS BIGINT) AS max_candidates, count(*) AS queries FROM q
""")
def lsh_candidate_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Mean candidates looked up per query over all tables (bucket-size arithmetic, no pairs)."""
    idx = _index(spark, sf)
    c = lsh.candidate_counts(idx, idx)
    return c.agg(V.rnd(F.avg("candidates")).alias("mean_candidates"),
                 F.max("candidates").cast("long").alias("max_candidates"), F.count("*").alias("queries"))


@register("lsh_kept_neighbours", sql=f"""
WITH {_PAIRS_SQL}, n AS (SELECT v.vec_id, count(nb.query_id) AS kept FROM v LEFT JOIN nb ON nb.query_id = v.vec_id GROUP BY v.vec_id)
SELECT {R('avg(kept)')} AS mean_kept, min(kept) AS least_kept, count(*) AS queries FROM n
""")
def lsh_kept_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours kept per query after the candidates of all tables are ranked."""
    nb = lsh.lsh_neighbours(_candidates(spark, sf), K).groupBy("query_id").agg(F.count(F.lit(1)).alias("kept"))
    q = derived.vectors(spark, sf).select(F.col("vec_id").alias("query_id")).join(nb, "query_id", "left")
    kept = F.coalesce("kept", F.lit(0))
    return q.agg(V.rnd(F.avg(kept)).alias("mean_kept"), F.min(kept).cast("long").alias("least_kept"), F.count(F.lit(1)).alias("queries"))


@register("lsh_neighbours", sql=f"""
WITH {_PAIRS_SQL}
SELECT query_id, neighbour_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank,
  {R('distance')} AS distance FROM nb
""")
def lsh_neighbours_q(spark: SparkSession, sf: str) -> DataFrame:
    """J1 + W1: 10 nearest among bucket-mates over all tables, each candidate once (D3)."""
    nb = lsh.lsh_neighbours(_candidates(spark, sf), K)
    return nb.select("query_id", "neighbour_id", "rank", V.rnd("distance").alias("distance"))


@register("lsh_classify", sql=f"""
WITH {_PAIRS_SQL},
agg AS (SELECT query_id, label, count(*) AS votes, min(distance) AS nearest FROM nb GROUP BY query_id, label),
best AS (SELECT query_id, label AS predicted FROM agg QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, nearest, label) = 1)
SELECT v.vec_id AS query_id, coalesce(best.predicted, -1) AS predicted FROM v LEFT JOIN best ON best.query_id = v.vec_id
""")
def lsh_classify_q(spark: SparkSession, sf: str) -> DataFrame:
    """LSH neighbour vote; a query without candidates gets the background label −1."""
    nb = lsh.lsh_neighbours(_candidates(spark, sf), K)
    return lsh.lsh_classify(nb, derived.vectors(spark, sf))


@register("lsh_mean_distance_by_l", sql=f"""
WITH {_HASH_SQL},
pt AS (SELECT a.table_id, a.vec_id AS query_id, b.vec_id AS neighbour_id, sqrt({SQD('a.v', 'b.v')}) AS distance
       FROM h a JOIN h b ON a.table_id = b.table_id AND a.bucket = b.bucket AND a.vec_id <> b.vec_id),
ls AS (SELECT * FROM range(1, {LSH_TABLES} + 1) t(L)),
u AS (SELECT L, query_id, neighbour_id, min(distance) AS distance FROM pt JOIN ls ON pt.table_id < ls.L GROUP BY L, query_id, neighbour_id
      QUALIFY row_number() OVER (PARTITION BY L, query_id ORDER BY min(distance), neighbour_id) <= {K}),
full_q AS (SELECT query_id FROM (SELECT L, query_id, count(*) AS n FROM u GROUP BY L, query_id) WHERE n = {K}
           GROUP BY query_id HAVING count(*) = (SELECT count(DISTINCT L) FROM u))
SELECT CAST(L AS INTEGER) AS L, {R('avg(distance)')} AS mean_distance, count(DISTINCT query_id) AS queries
FROM u WHERE query_id IN (SELECT query_id FROM full_q) GROUP BY L
""")
def lsh_mean_distance_by_l(spark: SparkSession, sf: str) -> DataFrame:
    """Mean distance to the 10 neighbours found with the first L tables, over queries full at every L."""
    by_l = lsh.neighbours_up_to_l(_candidates(spark, sf), K, LSH_TABLES)
    m = lsh.mean_neighbour_distance(by_l, K, LSH_TABLES)
    return m.select(F.col("L").cast("int").alias("L"), V.rnd("mean_distance").alias("mean_distance"), "queries")


@register("lsh_prefix_lookup", sql=f"""
WITH {_HASH_SQL},
p AS (SELECT vec_id, table_id, split_part(bucket, ':', 1) || ':' AS prefix, bucket FROM h),
s AS (SELECT table_id, prefix, count(*) AS rows FROM p GROUP BY table_id, prefix)
SELECT p.vec_id AS query_id, CAST(p.table_id AS INTEGER) AS table_id, s.rows - 1 AS prefix_matches FROM p JOIN s USING (table_id, prefix)
""")
def lsh_prefix_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Index rows whose bucket text starts with the query's first hash component and ':'.

    A colon-terminated prefix of a fixed-arity key is an equality on that
    component, so the lookup runs as an equi-join on bucket counts.
    """
    idx = _index(spark, sf).withColumn("prefix", F.concat(F.split("bucket", ":")[0], F.lit(":")))
    sizes = idx.groupBy("table_id", "prefix").agg(F.count("*").alias("rows"))
    j = idx.join(sizes, ["table_id", "prefix"]).where(F.col("bucket").startswith(F.col("prefix")))
    return j.select(F.col("vec_id").alias("query_id"), "table_id", (F.col("rows") - 1).alias("prefix_matches"))


@register("lsh_recall", sql=f"""
WITH {_PAIRS_SQL},
ex AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id FROM v a JOIN v b ON a.vec_id <> b.vec_id
       QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY sqrt({SQD('a.v', 'b.v')}), b.vec_id) <= {K})
SELECT {R('count(nb.neighbour_id) * 1.0 / count(*)')} AS recall, count(*) AS exact_pairs
FROM ex LEFT JOIN nb ON ex.query_id = nb.query_id AND ex.neighbour_id = nb.neighbour_id
""")
def lsh_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the exact 10 nearest neighbours that the LSH lookup finds."""
    from lodestar.operators.similarity import knn_join

    v = derived.vectors(spark, sf)
    exact = knn_join(v, v, K, exclude_self=True).select("query_id", "neighbour_id")
    found = lsh.lsh_neighbours(_candidates(spark, sf), K).select("query_id", "neighbour_id", F.lit(1).alias("hit"))
    j = exact.join(found, ["query_id", "neighbour_id"], "left")
    return j.agg(V.rnd(F.count("hit") / F.count("*")).alias("recall"), F.count("*").alias("exact_pairs"))


@register("lsh_bucketed_lookup", sql=f"""
WITH {_HASH_SQL}, p AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, min(a.table_id) AS t FROM h a JOIN h b
  ON a.table_id = b.table_id AND a.bucket = b.bucket AND a.vec_id <> b.vec_id GROUP BY 1, 2)
SELECT query_id, count(*) AS candidates, CAST(sum(neighbour_id) AS BIGINT) AS id_sum, CAST(min(t) AS INTEGER) AS first_table, true AS index_stays FROM p GROUP BY query_id
""")
def lsh_bucketed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """K3 + J1: the index stored by (table, bucket) and met by queries without another shuffle of its rows (told from the plan)."""
    import uuid

    name, path = f"lsh_index_{uuid.uuid4().hex}", scratch(spark, "bucketed")
    idx = cut_lineage(lsh.with_buckets(_index(spark, sf)))
    lsh.write_index(idx, path, name=name, buckets=16)
    stored, asked = lsh.read_index(spark, path, name), idx.hint("merge")  # too small an index would be broadcast
    pairs = lsh.single_pairs(asked, stored, LSH_TABLES)
    stays = lsh.index_stays(pairs, name)
    if idx.where("NOT single").limit(1).count():  # ids that share a table with themselves: their pairs are told apart by id
        pairs = pairs.unionByName(lsh.candidate_pairs(asked.where("NOT single"), stored)).unionByName(
            lsh.candidate_pairs(asked.where("single"), stored.where("NOT single")))
    out = cut_lineage(pairs.groupBy("query_id").agg(F.count(F.lit(1)).alias("candidates"), F.sum("neighbour_id").alias("id_sum"),
                                                    F.min("table_id").alias("first_table"), F.lit(stays).alias("index_stays")))
    spark.sql(f"DROP TABLE {name}")
    discard(spark, path)
    return out
