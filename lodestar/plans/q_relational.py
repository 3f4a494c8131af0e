"""Relational operators over the TPC-H-style tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import sampling
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R
from lodestar.session import domain, table


@register("filter_by_parent_category", sql="""
SELECT DISTINCT n.n_nationkey FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name IN ('EUROPE', 'ASIA')
""")
def filter_by_parent_category(spark: SparkSession, sf: str) -> DataFrame:
    """Ids whose parent category (region) is in a set."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey).where(F.col("r_name").isin("EUROPE", "ASIA"))
    return j.select("n_nationkey").distinct()


@register("invert_index", sql="""
SELECT event_type, user_id, row_number() OVER (PARTITION BY event_type ORDER BY user_id) AS position
FROM (SELECT DISTINCT event_type, user_id FROM events)
""")
def invert_index(spark: SparkSession, sf: str) -> DataFrame:
    """Category → sorted members, one row for each with its place, so a category with most members is no single row."""
    from lodestar.operators.prefix import grouped_row_number

    e = table(spark, sf, "events").select("event_type", "user_id").distinct()
    return grouped_row_number(e, ["event_type"], [("user_id", True)], "position")


@register("lookup_names", sql="""
SELECT n.n_name, count(*) AS lines, round(sum(l.l_extendedprice), 2) + 0.0 AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name
""")
def lookup_names(spark: SparkSession, sf: str) -> DataFrame:
    """Id → name lookup through dimension joins (the planner broadcasts the small dimensions)."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == n.n_nationkey)
    return j.groupBy("n_name").agg(F.count("*").alias("lines"), V.rnd(F.sum("l_extendedprice"), 2).alias("revenue"))


@register("group_concat_members", sql="""
SELECT r.r_name, array_to_string(list_sort(list(n.n_name)), ',') AS members
FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name
""")
def group_concat_members(spark: SparkSession, sf: str) -> DataFrame:
    """P10: parent → sorted member list as text."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    j = r.join(n, n.n_regionkey == r.r_regionkey)
    return j.groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("members"))


@register("multi_hot", sql="""
WITH d AS (SELECT list_sort(list_distinct(list(event_type))) AS dom FROM events),
u AS (SELECT user_id, list_distinct(list(event_type)) AS ts FROM events GROUP BY user_id)
SELECT user_id, array_to_string(list_transform(dom, lambda t: CAST(list_contains(ts, t) AS INTEGER)), ',') AS labels FROM u, d
""")
def multi_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted label domain → 0/1 vector per key (keys without labels never appear)."""
    e = table(spark, sf, "events")
    dom = domain(e, "event_type")
    u = e.groupBy("user_id").agg(F.collect_set("event_type").alias("ts"))
    mh = F.array(*[F.array_contains("ts", F.lit(t)).cast("int") for t in dom])
    return u.select("user_id", F.array_join(mh.cast("array<string>"), ",").alias("labels"))


@register("drop_missing", sql="""
SELECT d.lang, count(*) AS kept FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL AND d.text IS NOT NULL GROUP BY d.lang
""")
def drop_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a missing part (no label, no text) dropped."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "text")
    l = table(spark, sf, "labels")
    j = d.join(l, "doc_id", "left").dropna(subset=["quality", "text"])
    return j.groupBy("lang").agg(F.count("*").alias("kept"))


@register("annotations_for_images", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS lines, round(sum(l_quantity), 2) + 0.0 AS qty FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY l_returnflag, l_linestatus
""")
def annotations_for_images(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations of a chosen set of images (left semi join)."""
    li = table(spark, sf, "lineitem")
    ids = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    s = li.join(ids, "l_orderkey", "left_semi")
    return s.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("lines"), V.rnd(F.sum("l_quantity"), 2).alias("qty"))


@register("label_from_hierarchy", sql="""
WITH a AS (SELECT l.l_orderkey, r.r_name,
             row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber DESC, l.l_partkey DESC, l.l_suppkey DESC) AS rn
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
           JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT o.o_orderkey, CASE WHEN a.r_name = 'EUROPE' THEN 1 ELSE -1 END AS y
FROM orders o JOIN a ON a.l_orderkey = o.o_orderkey AND a.rn = 1
""")
def label_from_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """Image → ±1 by the parent category of its last annotation (deterministic max_by)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    a = li.join(s, li.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == n.n_nationkey).join(
        r, F.col("n_regionkey") == r.r_regionkey)
    last = a.groupBy("l_orderkey").agg(F.max_by("r_name", F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("r_name"))
    o = table(spark, sf, "orders").select("o_orderkey")
    j = o.join(last, o.o_orderkey == last.l_orderkey)
    return j.select("o_orderkey", F.when(F.col("r_name") == "EUROPE", 1).otherwise(-1).alias("y"))


@register("exclude_used", sql="""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def exclude_used(spark: SparkSession, sf: str) -> DataFrame:
    """Customers not already used by an urgent order (left anti join)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    used = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return sampling.exclude(c, used, ["c_custkey"])


@register("multiset_difference", sql="""
SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey AS k FROM customer
""")
def multiset_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Multiset difference (EXCEPT ALL)."""
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    return sampling.difference(a, b)


@register("distinct_values", sql="SELECT DISTINCT user_id, event_type FROM events")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct rows."""
    return table(spark, sf, "events").select("user_id", "event_type").distinct()


@register("sort_by_price", sql="""
SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS position FROM part
""")
def sort_by_price(spark: SparkSession, sf: str) -> DataFrame:
    """Total order with positions, numbered range by range (no single-task global sort)."""
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return sampling.sort_by(p, [("p_retailprice", False), ("p_partkey", True)])


@register("crosstab_to_long", sql="""
SELECT p_brand AS row_key, p_type AS col_key, round(sum(p_retailprice), 2) + 0.0 AS value FROM part GROUP BY p_brand, p_type
""")
def crosstab_to_long(spark: SparkSession, sf: str) -> DataFrame:
    """A wide cross-tab (brand × type) back to long (row_key, col_key, value) rows."""
    p = table(spark, sf, "part")
    types = [r[0] for r in p.select("p_type").distinct().orderBy("p_type").collect()]  # the column domain (bounded)
    wide = p.groupBy("p_brand").pivot("p_type", types).agg(F.sum("p_retailprice"))
    long = wide.unpivot("p_brand", types, "col_key", "value").where(F.col("value").isNotNull())
    return long.select(F.col("p_brand").alias("row_key"), "col_key", V.rnd("value", 2).alias("value"))


@register("math_functions", sql=f"""
SELECT p_partkey, {R('ln(p_retailprice)')} AS ln_price, {R('log10(p_retailprice)')} AS log10_price,
  {R('exp(p_size / 50.0)')} AS exp_size, {R('sqrt(p_retailprice)')} AS sqrt_price, {R('pow(p_size, 1.5)')} AS pow_size,
  {R('abs(p_size - 25)', 1)} AS abs_dev, CAST(floor(p_retailprice / 7) AS BIGINT) AS floor_p, CAST(ceil(p_retailprice / 7) AS BIGINT) AS ceil_p,
  {R('p_retailprice / 3', 2)} AS round_p, CAST(sign(p_size - 25) AS INTEGER) AS sign_dev,
  least(p_size, 25) AS min_size, greatest(p_size, 25) AS max_size
FROM part
""")
def math_functions(spark: SparkSession, sf: str) -> DataFrame:
    """F16: log, log10, exp, sqrt, pow, abs, floor, ceil, round, sign, min, max."""
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", V.rnd(F.log("p_retailprice")).alias("ln_price"), V.rnd(F.log10("p_retailprice")).alias("log10_price"),
        V.rnd(F.exp(F.col("p_size") / 50.0)).alias("exp_size"), V.rnd(F.sqrt("p_retailprice")).alias("sqrt_price"),
        V.rnd(F.pow("p_size", 1.5)).alias("pow_size"), V.rnd(F.abs(F.col("p_size") - 25), 1).alias("abs_dev"),
        F.floor(F.col("p_retailprice") / 7).alias("floor_p"), F.ceil(F.col("p_retailprice") / 7).alias("ceil_p"),
        V.rnd(F.col("p_retailprice") / 3, 2).alias("round_p"), F.signum(F.col("p_size") - 25).cast("int").alias("sign_dev"),
        F.least("p_size", F.lit(25)).alias("min_size"), F.greatest("p_size", F.lit(25)).alias("max_size"),
    )


@register("string_functions", sql="""
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, array_to_string(list_reverse(string_split(p_name, ' ')), ':') AS joined,
  starts_with(p_brand, 'Brand#1') AS brand_prefix, format('{}-{:05d}', p_type, p_size) AS formatted FROM part
""")
def string_functions(spark: SparkSession, sf: str) -> DataFrame:
    """split, join, prefix match and formatting."""
    p = table(spark, sf, "part")
    return p.select(
        "p_partkey", F.split("p_name", " ")[0].alias("first_word"),
        F.array_join(F.reverse(F.split("p_name", " ")), ":").alias("joined"),
        F.col("p_brand").startswith("Brand#1").alias("brand_prefix"),
        F.format_string("%s-%05d", "p_type", "p_size").alias("formatted"),
    )


@register("dense_index_map", sql="""
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS brand_index,
  CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'STANDARD' THEN 1 ELSE 2 END AS type_code FROM part
""")
def dense_index_map(spark: SparkSession, sf: str) -> DataFrame:
    """id → dense index via a joined domain table; a literal map for a fixed lookup."""
    p = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    dom = p.select("p_brand").distinct()
    dom = sampling.sort_by(dom.withColumn("_b", F.lit(0)), [("_b", True), ("p_brand", True)], "pos").select(
        "p_brand", (F.col("pos") - 1).cast("int").alias("brand_index"))
    lit_map = F.create_map(F.lit("ECONOMY"), F.lit(0), F.lit("STANDARD"), F.lit(1))
    j = p.join(dom, "p_brand")
    return j.select("p_partkey", "brand_index",
                    F.coalesce(F.element_at(lit_map, F.col("p_type")), F.lit(2)).alias("type_code"))


@register("json_field", sql="""
SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, count(*) AS n FROM events GROUP BY event_type
""")
def json_field(spark: SparkSession, sf: str) -> DataFrame:
    """a JSON path field extracted from a text column."""
    e = table(spark, sf, "events")
    return e.groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k_sum"),
                                       F.count("*").alias("n"))
