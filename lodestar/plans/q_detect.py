"""Detection queries: IoU labelling, projection, pooling, mining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.operators import boxes, imaging, sampling
from lodestar.plans import derived
from lodestar.plans.derived import BOXES_SQL, IMG_H, IMG_W, VECTORS_SQL
from lodestar.plans.registry import register
from lodestar.plans.sqlfrag import R
from lodestar.session import cut_lineage, discard, scratch

_COLS = ("x", "y", "w", "h")


_LABELLED_SQL = f"""b AS ({BOXES_SQL}),
t AS (SELECT * FROM b WHERE l_linenumber = 1),
p AS (SELECT * FROM b WHERE l_linenumber <> 1),
m AS (SELECT p.img_id, p.l_partkey, p.l_suppkey, p.l_linenumber, p.w, max({boxes.iou_sql('p', 't')}) AS max_iou
      FROM p JOIN t ON p.img_id = t.img_id AND p.category_id = t.category_id
      GROUP BY p.img_id, p.l_partkey, p.l_suppkey, p.l_linenumber, p.w),
lab AS (SELECT p.*, coalesce(m.max_iou, 0.0) AS max_iou, CAST(coalesce(m.max_iou, 0.0) > 0.5 AS INTEGER) AS label
        FROM p LEFT JOIN m USING (img_id, l_partkey, l_suppkey, l_linenumber, w))"""


def labelled(spark: SparkSession, sf: str, pair_limit: int | None = None) -> DataFrame:
    truth, props = derived.truth_and_proposals(spark, sf)
    kw = {} if pair_limit is None else {"pair_limit": pair_limit}
    return boxes.label_proposals(props, truth, ["img_id", "category_id"], **kw)


_OUT = ["img_id", "l_partkey", "l_suppkey", "l_linenumber", "x", "y", "w", "h", "category_id"]


@register("label_proposals", sql=f"""
WITH {_LABELLED_SQL}
SELECT img_id, l_partkey, l_suppkey, l_linenumber, x, y, w, h, category_id, {R('max_iou')} AS max_iou, label FROM lab
""")
def label_proposals_q(spark: SparkSession, sf: str) -> DataFrame:
    """J2 + F7: best IoU of each proposal against same-category truth boxes of its image; positive above 0.5."""
    lab = labelled(spark, sf)
    return lab.select(*_OUT, V.rnd("max_iou").alias("max_iou"), "label")


@register("iou_pairs_summary", sql=f"""
WITH {_LABELLED_SQL},
pr AS (SELECT {boxes.iou_sql('p', 't')} AS iou FROM p JOIN t ON p.img_id = t.img_id)
SELECT count(*) AS pairs, CAST(sum(CAST(iou > 0.5 AS INTEGER)) AS BIGINT) AS over_half, {R('avg(iou)')} AS mean_iou FROM pr
""")
def iou_pairs_summary(spark: SparkSession, sf: str) -> DataFrame:
    """IoU over every proposal–truth pair in the same image (count, share over 0.5, mean)."""
    truth, props = derived.truth_and_proposals(spark, sf)
    r = boxes.iou_summary(props, truth, ["img_id"])
    return r.select("pairs", F.col("over").alias("over_half"), V.rnd(F.col("total") / F.col("pairs")).alias("mean_iou"))


def _cell_sql(scaled: str) -> str:
    nearest = f"CAST(floor(({scaled} + 1 + {boxes.GRID_STRIDE // 2}) / {float(boxes.GRID_STRIDE)}) AS BIGINT)"
    return f"greatest(1, least({nearest}, {boxes.GRID_CELLS}))"


def _first_sql(start: str, full: int) -> str:
    return f"CAST({_cell_sql(f'floor({start} * {boxes.GRID_INPUT} / {full}.0)')} - 1 AS INTEGER)"


def _end_sql(start: str, size: str, full: int) -> str:
    return f"CAST({_cell_sql(f'ceil(({start} + {size}) * {boxes.GRID_INPUT} / {full}.0)')} AS INTEGER)"


@register("project_boxes", sql=f"""
WITH b AS ({BOXES_SQL})
SELECT img_id, l_partkey, l_suppkey, l_linenumber, w,
  {_first_sql('x', IMG_W)} AS gx0, {_first_sql('y', IMG_H)} AS gy0, {_end_sql('x', 'w', IMG_W)} AS gx1, {_end_sql('y', 'h', IMG_H)} AS gy1
FROM b
""")
def project_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """F8: every box projected onto the 13×13 stride-16 grid of a 224×224 input (image 640×480)."""
    b = derived.boxes(spark, sf)
    pb = boxes.project_box(F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.lit(IMG_W), F.lit(IMG_H))
    return b.select("img_id", "l_partkey", "l_suppkey", "l_linenumber", "w", pb.alias("g")).select(
        "img_id", "l_partkey", "l_suppkey", "l_linenumber", "w",
        F.col("g.x0").alias("gx0"), F.col("g.y0").alias("gy0"), F.col("g.x1").alias("gx1"), F.col("g.y1").alias("gy1"))


def _pool_sql() -> str:
    # tensor 4×4×4 (C, W, H); crop x0..x1, y0..y1 (end exclusive); levels 1, 3, 6
    cell = "v[ci * 16 + xx * 4 + yy + 1]"
    lv = []
    for k in (1, 3, 6):
        lv.append(
            f"flatten(list_transform(range(0, 4), lambda ci: flatten(list_transform(range(0, {k}), lambda qx: "
            f"list_transform(range(0, {k}), lambda qy: list_max(flatten(list_transform("
            f"range(x0 + CAST(floor(qx * (x1 - x0) / {k}) AS BIGINT), x0 + CAST(ceil((qx + 1) * (x1 - x0) / {k}) AS BIGINT)), "
            f"lambda xx: list_transform(range(y0 + CAST(floor(qy * (y1 - y0) / {k}) AS BIGINT), "
            f"y0 + CAST(ceil((qy + 1) * (y1 - y0) / {k}) AS BIGINT)), lambda yy: {cell})))))))))"
        )
    return "list_concat(" + ", ".join(lv) + ")"


@register("pyramid_pool", sql=f"""
WITH v AS ({VECTORS_SQL}),
bx AS (SELECT vec_id, v, label % 2 AS x0, (label // 2) % 2 AS y0, 4 AS x1, 3 + label % 2 AS y1 FROM v),
pl AS (SELECT vec_id, {_pool_sql()} AS pooled FROM bx)
SELECT vec_id, CAST(len(pooled) AS INTEGER) AS n, {R('list_sum(pooled)')} AS total, {R('pooled[1]')} AS first FROM pl
""")
def pyramid_pool(spark: SparkSession, sf: str) -> DataFrame:
    """pyramid max pooling (1, 3, 6) of each embedding as a 4×4×4 tensor over a label-derived crop."""
    v = derived.vectors(spark, sf).select(
        "vec_id", "v", (F.col("label") % 2).alias("x0"), (F.floor(F.col("label") / 2) % 2).cast("int").alias("y0"),
        F.lit(4).alias("x1"), (F.lit(3) + F.col("label") % 2).alias("y1"))
    p = imaging.pyramid_max_pool(v, "v", 4, 4, 4, ("x0", "y0", "x1", "y1"))
    return p.select("vec_id", F.size("pooled").alias("n"), V.rnd(V.vsum("pooled")).alias("total"),
                    V.rnd(F.col("pooled")[0]).alias("first"))


@register("attach_image_features", sql=f"""
WITH {_LABELLED_SQL}, v AS ({VECTORS_SQL}), nv AS (SELECT count(*) AS n FROM v)
SELECT lab.category_id, lab.label, count(*) AS boxes, {R('sum(list_sum(v.v))', 4)} AS feature_sum
FROM lab, nv JOIN v ON v.vec_id = lab.img_id % nv.n GROUP BY lab.category_id, lab.label
""")
def attach_image_features(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled proposals joined N:1 to their image's feature vector (image i uses embedding i mod n)."""
    lab = labelled(spark, sf)
    v = derived.vectors(spark, sf)
    n = v.count()  # one scalar: the size of the feature table
    feats = v.select(F.col("vec_id").alias("feat_id"), "v")
    j = boxes.attach_features(lab.withColumn("feat_id", F.col("img_id") % n), feats, "feat_id")
    return j.groupBy("category_id", "label").agg(F.count("*").alias("boxes"),
                                                 V.rnd(F.sum(V.vsum("v")), 4).alias("feature_sum"))


@register("union_labelled", sql=f"""
WITH {_LABELLED_SQL}
SELECT category_id, label, count(*) AS boxes FROM lab GROUP BY category_id, label
""")
def union_labelled_q(spark: SparkSession, sf: str) -> DataFrame:
    """Positives and negatives unioned with a label column, counted per category."""
    lab = labelled(spark, sf)
    u = sampling.union_labelled(lab.where("label = 1").drop("label"), lab.where("label = 0").drop("label"))
    return u.groupBy("category_id", "label").agg(F.count("*").alias("boxes"))


@register("negative_ratio_sample", sql=f"""
WITH {_LABELLED_SQL},
pc AS (SELECT category_id, count(*) AS n_pos FROM lab WHERE label = 1 GROUP BY category_id),
ng AS (SELECT lab.*, {sampling.hash_order_sql('(img_id * 1000 + l_linenumber)')} AS h FROM lab WHERE label = 0),
kept AS (SELECT ng.* FROM ng LEFT JOIN pc USING (category_id)
         QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY h, (img_id * 1000 + l_linenumber), l_partkey, l_suppkey, w)
                 <= floor(coalesce(n_pos, 0) * 3))
SELECT category_id, count(*) AS negatives FROM kept GROUP BY category_id
""")
def negative_ratio_sample_q(spark: SparkSession, sf: str) -> DataFrame:
    """T5: at most 3 negatives per positive in each category, seeded hash order; labels are made once and written down."""
    path = scratch(spark, "labelled")
    sk = (F.col("img_id") * 1000 + F.col("l_linenumber")).alias("sk")
    labelled(spark, sf).select("category_id", "label", sk, "l_partkey", "l_suppkey", "w").write.parquet(path)
    lab = spark.read.parquet(path)
    pc = lab.where("label = 1").groupBy("category_id").agg(F.count("*").alias("n_pos"))
    kept = sampling.negative_ratio_sample(lab.where("label = 0"), pc, "category_id", "sk", 3, ties=["l_partkey", "l_suppkey", "w"])
    out = cut_lineage(kept.groupBy("category_id").agg(F.count("*").alias("negatives")))
    discard(spark, path)
    return out


@register("concat_box_lists", sql=f"""
WITH b AS ({BOXES_SQL})
SELECT img_id, CAST(count(*) AS INTEGER) AS n_boxes, CAST(sum(w) AS BIGINT) AS w_sum FROM b GROUP BY img_id
""")
def concat_box_lists(spark: SparkSession, sf: str) -> DataFrame:
    """U4: box lists of an image (one per supplier) taken together: lists stay apart, only their sizes and sums meet."""
    b = derived.boxes(spark, sf).groupBy("img_id", "l_suppkey").agg(F.collect_list(F.struct("x", "y", "w", "h")).alias("bl"))
    per_list = b.select("img_id", F.size("bl").alias("n"), F.aggregate("bl", F.lit(0).cast("long"), lambda a, x: a + x["w"]).alias("w"))
    return per_list.groupBy("img_id").agg(F.sum("n").cast("int").alias("n_boxes"), F.sum("w").alias("w_sum"))
