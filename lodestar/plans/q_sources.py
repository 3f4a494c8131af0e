"""Readers and writers as round trips: what a writer leaves in the shared folder is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import userfn
from lodestar.functions import vectors as V
from lodestar.operators import lsh
from lodestar.plans import derived
from lodestar.plans.derived import BOXES_SQL, VECTORS_SQL
from lodestar.plans.q_lsh import _HASH_SQL, _index
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R
from lodestar.session import cut_lineage, discard, scratch, table
from lodestar.sources import readers, sinks


def _kept(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """A result that no longer needs the files it was read from, which are deleted."""
    done = cut_lineage(df)
    discard(spark, path)
    return done


@register("delimited_round_trip", sql=f"""
SELECT CAST(p_size AS INTEGER) AS label, count(*) AS n, {R('sum(p_retailprice)', 2)} AS price, {R('sum(p_partkey)', 2)} AS key_sum FROM part GROUP BY 1
""")
def delimited_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Part written as headerless comma-separated text and read back as features and a label."""
    path = scratch(spark, "delimited")
    table(spark, sf, "part").select("p_retailprice", "p_partkey", "p_size").write.csv(path)
    d = readers.read_delimited(spark, path, 3, sep=",")
    return _kept(spark, d.groupBy("label").agg(F.count("*").alias("n"), V.rnd(F.sum(F.col("features")[0]), 2).alias("price"),
                                               V.rnd(F.sum(F.col("features")[1]), 2).alias("key_sum")), path)


@register("labelled_rows_round_trip", sql=f"""
WITH v AS ({VECTORS_SQL})
SELECT label, count(*) AS n, {R('sum(list_sum(v))', 4)} AS total, {R('sum(v[64])', 4)} AS last FROM v GROUP BY label
""")
def labelled_rows_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings written as lines "label, v1, v2, ..." and read back."""
    path = scratch(spark, "lines")
    v = derived.vectors(spark, sf)
    v.select(F.concat_ws(",", F.col("label").cast("string"), F.col("v").cast("array<string>")).alias("value")).write.text(path)
    d = readers.read_labelled_rows(spark, path)
    return _kept(spark, d.groupBy("label").agg(F.count("*").alias("n"), V.rnd(F.sum(V.vsum("features")), 4).alias("total"),
                                               V.rnd(F.sum(F.col("features")[63]), 4).alias("last")), path)


_ANNOTATIONS_SQL = """
SELECT c.category_id, count(*) AS n, CAST(sum(w) AS BIGINT) AS w_sum, count(DISTINCT img_id) AS images
FROM (SELECT o_orderkey % 18 AS category_id, o_orderkey AS img_id, 50 + o_orderkey % 50 AS w FROM orders) c GROUP BY c.category_id
"""


def _annotations(spark: SparkSession, sf: str, multi_line: bool) -> DataFrame:
    """Annotation files, one JSON object for each thousand orders, read back as tables and joined."""
    path = scratch(spark, "annotations")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("id"))
    shape = o.select(
        F.floor(F.col("id") / 1000).alias("part"),
        F.struct("id", F.concat(F.col("id").cast("string"), F.lit(".jpg")).alias("file_name"), F.lit(640).alias("width"), F.lit(480).alias("height")).alias("image"),
        F.struct("id", F.col("id").alias("image_id"), (F.col("id") % 18).alias("category_id"),
                 F.array(F.lit(0.0), F.lit(0.0), (F.lit(50.0) + F.col("id") % 50), F.lit(1.0)).alias("bbox")).alias("annotation"))
    files = shape.groupBy("part").agg(F.collect_list("image").alias("images"), F.collect_list("annotation").alias("annotations"))
    cats = F.transform(F.sequence(F.lit(0), F.lit(17)), lambda i: F.struct(i.cast("long").alias("id"), i.cast("string").alias("name"), F.lit("all").alias("supercategory")))
    files.withColumn("categories", F.when(F.col("part") == 0, cats).otherwise(F.array().cast(cats_type()))).drop("part").write.json(path)
    t = readers.read_annotations(spark, path, multi_line)
    j = t["annotations"].join(t["images"].select(F.col("id").alias("image_id"), "width"), "image_id").join(
        t["categories"].select(F.col("id").alias("category_id"), "name"), "category_id")
    return _kept(spark, j.groupBy("category_id").agg(F.count("*").alias("n"), F.sum("w").cast("long").alias("w_sum"),
                                                     F.countDistinct("image_id").alias("images")), path)


@register("annotations_round_trip", sql=_ANNOTATIONS_SQL)
def annotations_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """S3: annotation objects read as lines."""
    return _annotations(spark, sf, False)


@register("annotation_objects_round_trip", sql=_ANNOTATIONS_SQL)
def annotation_objects_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """S3: the same files read as text that may be split anywhere, by the state of brackets and quotes."""
    return _annotations(spark, sf, True)


def cats_type() -> str:
    return "array<struct<id:bigint,name:string,supercategory:string>>"


@register("feature_bundle_round_trip", sql=f"""
WITH v AS ({VECTORS_SQL}) SELECT vec_id, {R('list_sum(v)')} AS total FROM v
""")
def feature_bundle_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Parallel lists of ids and features, bundles of about 64, back to one row per id."""
    path = scratch(spark, "bundles")
    v = derived.vectors(spark, sf)
    bundles = v.groupBy(F.floor(F.col("vec_id") / 64).alias("bundle")).agg(F.collect_list(F.struct("vec_id", "v")).alias("p"))
    bundles.select(F.col("p.vec_id").alias("ids"), F.col("p.v").alias("features")).write.parquet(path)
    d = readers.read_feature_bundle(spark, path)
    return _kept(spark, d.select(F.col("id").alias("vec_id"), V.rnd(V.vsum("features")).alias("total")), path)


@register("training_set_round_trip", sql=f"""
WITH b AS ({BOXES_SQL}) SELECT count(*) AS n, CAST(sum(w) AS BIGINT) AS w_sum FROM b WHERE l_linenumber <> 1 AND category_id = 3
""")
def training_set_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """K5 + S5: boxes written by split and category; one partition of one split is read back."""
    path = scratch(spark, "training")
    b = derived.boxes(spark, sf).withColumn("split", F.when(F.col("l_linenumber") == 1, "truth").otherwise("train"))
    sinks.write_training_set(b, path)
    d = readers.read_partitioned(spark, path, "train", 3)
    return _kept(spark, d.agg(F.count("*").alias("n"), F.sum("w").cast("long").alias("w_sum")), path)


@register("index_round_trip", sql=f"""
WITH {_HASH_SQL} SELECT CAST(table_id AS INTEGER) AS table_id, count(*) AS rows, count(DISTINCT bucket) AS buckets FROM h WHERE table_id < 3 GROUP BY table_id
""")
def index_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """K3 + S6: the LSH index written by table; three tables are read back."""
    path = scratch(spark, "index")
    lsh.write_index(_index(spark, sf), path)
    d = lsh.read_index(spark, path).where("table_id < 3")
    return _kept(spark, d.groupBy(F.col("table_id").cast("int").alias("table_id")).agg(
        F.count("*").alias("rows"), F.countDistinct("bucket").alias("buckets")), path)


@register("model_round_trip", sql=f"""
WITH v AS ({VECTORS_SQL}), e AS (SELECT label, r.i AS pos, v[r.i + 1] AS x FROM v, range(0, 64) r(i)),
m AS (SELECT label, pos, avg(x) AS mean FROM e GROUP BY label, pos)
SELECT 'centre-' || CAST(label AS VARCHAR) AS model_id, CAST(count(*) AS INTEGER) AS n, {R('sum(mean)')} AS total FROM m GROUP BY label
""")
def model_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """K1 + S7: one model per label (its mean vector) saved by model and read back as a matrix."""
    from lodestar.operators.moments import column_moments

    path = scratch(spark, "models")
    m = column_moments(derived.vectors(spark, sf), by=["label"]).groupBy("label").agg(
        F.sort_array(F.collect_list(F.struct("pos", "mean"))).alias("m"))  # one entry for each position
    sinks.save_model(m.select(F.concat(F.lit("centre-"), F.col("label").cast("string")).alias("model_id"), F.lit(0).alias("layer"),
                              F.lit(0).alias("i"), F.col("m.mean").alias("values")), path)
    d = readers.read_matrix(spark, path)
    return _kept(spark, d.select("model_id", F.size("values").alias("n"), V.rnd(V.vsum("values")).alias("total")), path)


@register("report_round_trip", sql=f"""
SELECT o_orderpriority AS priority, count(*) AS n, {R('avg(o_totalprice)', 4)} AS mean_price FROM orders GROUP BY 1
""")
def report_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """K2: a metric table per priority as CSV with a header, read back by its header."""
    path = scratch(spark, "report")
    r = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count("*").alias("n"), V.rnd(F.avg("o_totalprice"), 4).alias("mean_price"))
    sinks.write_report(r, path)
    return _kept(spark, spark.read.option("header", True).schema("priority string, n long, mean_price double").csv(path), path)


@register("metrics_round_trip", sql=f"""
SELECT event_type AS model_id, count(*) AS steps, {R('max(value)')} AS best FROM events GROUP BY 1
""")
def metrics_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """K4: a metric history appended in two batches, one of them twice, as a retry would; every step counts once."""
    path = scratch(spark, "history")
    e = table(spark, sf, "events").select(F.col("event_type").alias("model_id"), F.col("event_id").alias("step"),
                                          F.lit("value").alias("metric"), "value")
    for batch in ("step % 2 = 0", "step % 2 = 1", "step % 2 = 1"):
        sinks.append_metrics(e.where(batch), path)
    d = sinks.read_metrics(spark, path)
    return _kept(spark, d.groupBy("model_id").agg(F.count("*").alias("steps"), V.rnd(F.max("value")).alias("best")), path)


@register("image_catalog", sql="""
SELECT p_brand, count(*) AS present FROM part WHERE length(p_name) > 0 GROUP BY p_brand
""")
def image_catalog_q(spark: SparkSession, sf: str) -> DataFrame:
    """Parts whose image file is there: a file per group of parts lists them; empty files do not count."""
    path = scratch(spark, "images")
    p = table(spark, sf, "part")
    p.select(F.col("p_partkey").cast("string").alias("value"), (F.col("p_partkey") % 50).alias("group")).where(
        F.length("value") > 0).write.partitionBy("group").text(path)
    files = readers.image_catalog(spark, path, "*.txt")
    there = files.select(F.regexp_extract("path", r"group=(\d+)", 1).cast("long").alias("group")).distinct()
    j = readers.with_images(p.withColumn("group", F.col("p_partkey") % 50), there, "group")
    return _kept(spark, j.groupBy("p_brand").agg(F.count("*").alias("present")), path)


@register("map_with_shared_value", sql=f"""
SELECT p_partkey, {R('p_retailprice * (CASE WHEN p_size > 25 THEN 0.9 ELSE 1.1 END)', 4)} AS price FROM part
""")
def map_with_shared_value(spark: SparkSession, sf: str) -> DataFrame:
    """A user function over batches with shared arguments (two factors by size)."""
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")

    def adjust(pdf, factors):
        return pdf.assign(price=pdf["p_retailprice"] * [factors[s > 25] for s in pdf["p_size"]])[["p_partkey", "price"]]

    kind = p.schema["p_partkey"].dataType.simpleString()
    d = userfn.map_with_broadcast(p, adjust, {True: 0.9, False: 1.1}, f"p_partkey {kind}, price double")
    return d.select("p_partkey", V.rnd("price", 4).alias("price"))


@register("boxes_of_images", sql=f"""
WITH b AS ({BOXES_SQL}) SELECT img_id, count(*) AS n, CAST(sum(x + y + w + h) AS BIGINT) AS total FROM b GROUP BY img_id
""")
def boxes_of_images(spark: SparkSession, sf: str) -> DataFrame:
    """An image's box list as rows."""
    b = derived.boxes(spark, sf).groupBy("img_id", "l_suppkey").agg(F.collect_list(F.struct("x", "y", "w", "h")).alias("boxes"))
    rows = userfn.explode_boxes(b, "boxes")
    return rows.groupBy("img_id").agg(F.count("*").alias("n"), F.sum(F.col("x") + F.col("y") + F.col("w") + F.col("h")).cast("long").alias("total"))

