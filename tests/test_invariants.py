"""Invariants and golden cases for operators whose answer is not a single SQL query."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import boxes, events, linear, lsh, network, sampling, similarity
from lodestar.plans import derived
from tests.conftest import SF_MID, SF_SMALL


def test_knn_blocks_equal_expression_form(spark):
    v = derived.vectors(spark, SF_SMALL)
    a = similarity.knn_join(v, v, 5, exclude_self=True, cell_rows=40)
    b = similarity.knn_join_expr(v, v, 5, exclude_self=True)
    ra = sorted((r.query_id, r.neighbour_id, r.rank) for r in a.collect())
    rb = sorted((r.query_id, r.neighbour_id, r.rank) for r in b.collect())
    assert ra == rb


def test_lsh_hot_bucket_path_matches_join_path(spark):
    idx = lsh.hash_table(derived.vectors(spark, SF_SMALL), 3, 2, 0.5, 64)
    v = derived.vectors(spark, SF_SMALL)
    cold = lsh.scored_candidates(idx, idx, v, v, 5, pair_limit=10 ** 12)
    hot = lsh.scored_candidates(idx, idx, v, v, 5, pair_limit=1)  # every bucket takes the blocked path
    key = lambda r: (r.query_id, r.neighbour_id, r["rank"], round(r.distance, 9))
    assert sorted(map(key, lsh.lsh_neighbours(cold, 5).collect())) == sorted(map(key, lsh.lsh_neighbours(hot, 5).collect()))
    by_l = lambda r: (r.L, *key(r))
    assert sorted(map(by_l, lsh.neighbours_up_to_l(cold, 5, 3).collect())) == sorted(map(by_l, lsh.neighbours_up_to_l(hot, 5, 3).collect()))


def test_iou_hot_image_path_matches_join_path(spark):
    truth, props = derived.truth_and_proposals(spark, SF_SMALL)
    a = boxes.label_proposals(props, truth, ["img_id", "category_id"], pair_limit=10 ** 12)
    b = boxes.label_proposals(props, truth, ["img_id", "category_id"], pair_limit=0)
    ka = sorted((r.box_id, round(r.max_iou, 9), r.label) for r in a.collect())
    kb = sorted((r.box_id, round(r.max_iou, 9), r.label) for r in b.collect())
    assert ka == kb


def test_boxes_dealt_by_image_stay_where_they_are(spark):
    rng = np.random.default_rng(3)
    rows = [(f"b{i}", int(i % 9) or None, int(i % 2), *map(int, rng.integers(1, 60, 4)), i % 5 == 0) for i in range(400)]
    b = spark.createDataFrame(rows, "box_id string, img_id long, category_id int, x int, y int, w int, h int, truth boolean")
    b = b.repartition(4, "img_id", "category_id")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit in (10 ** 6, 60):
            lab = boxes.label_proposals(b.where("NOT truth"), b.where("truth"), ["img_id", "category_id"], pair_limit=limit)
            if limit > 60:
                assert "ENSURE_REQUIREMENTS" not in lab._jdf.queryExecution().executedPlan().toString()
            got = {r["box_id"]: r["max_iou"] for r in lab.collect()}
            assert len(got) == lab.count() == sum(not r[7] for r in rows)
            for r in rows:
                if not r[7]:
                    near = [t for t in rows if t[7] and t[1] == r[1] is not None and t[2] == r[2]]
                    want = boxes.iou_np(np.array([r[3:7]]), np.array([t[3:7] for t in near])).max() if near else 0.0
                    assert abs(got[r[0]] - want) < 1e-12
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)


def test_iou_sums_of_a_hot_image(spark):
    truth, props = derived.truth_and_proposals(spark, SF_SMALL)
    a, b = (boxes.iou_summary(props, truth, ["category_id"], pair_limit=n).first() for n in (10 ** 12, 0))
    assert (a.pairs, a.over) == (b.pairs, b.over) and a.pairs > 1000 and abs(a.total - b.total) < 1e-6


def test_iou_golden():
    same = boxes.iou_np(np.array([[1, 2, 10, 20]]), np.array([[1, 2, 10, 20]]))
    apart = boxes.iou_np(np.array([[0, 0, 5, 5]]), np.array([[100, 100, 5, 5]]))
    assert same[0, 0] == 1.0 and apart[0, 0] == 0.0


def test_average_precision_golden(spark):
    from lodestar.operators import metrics

    ap = metrics.average_precision(derived.scored_docs(spark, SF_MID), "score", "label").first()["ap"]
    assert abs(ap - 0.8659533047792252) < 1e-12


def test_shortest_path_golden(spark):
    e = spark.createDataFrame(
        [(1, 2, 10), (1, 3, 25), (2, 3, 35), (3, 4, 20), (2, 5, 15), (3, 5, 35), (4, 5, 40), (4, 6, 30), (5, 6, 20)],
        "src long, dst long, cost long")
    d = {r.node: r.dist for r in network.shortest_paths(e, 1).collect()}
    assert d[6] == 45.0


def test_components_golden(spark):
    arcs = spark.createDataFrame([(1, 2, 1), (2, 5, 1), (5, 1, 1), (3, 4, 1), (4, 3, 1)], "src long, dst long, cost long")
    comp = {r.node: r.comp for r in network.components(arcs).collect()}
    assert comp == {1: 1, 2: 1, 5: 1, 3: 3, 4: 3}


def test_pca_agrees_with_library(spark):
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    v = derived.vectors(spark, SF_SMALL)
    _, _, vecs = linear.pca(v, 2)
    lib = PCA(k=2, inputCol="f").fit(v.select(array_to_vector("v").alias("f"))).pc.toArray()
    for j in range(2):
        cos = abs(float(vecs[:, j] @ lib[:, j]) / (np.linalg.norm(vecs[:, j]) * np.linalg.norm(lib[:, j])))
        assert cos > 0.999


def test_gradient_training_reduces_loss(spark):
    from lodestar.plans.q_models import logistic_gd

    h = logistic_gd(spark, SF_SMALL).orderBy("iteration").collect()
    assert h[-1].loss < h[0].loss


def test_running_totals_equal_global_window(spark):
    from pyspark.sql import Window

    from lodestar.operators.prefix import running_totals

    df = spark.range(0, 5000).select((F.col("id") % 97).alias("k"), F.col("id"), (F.col("id") % 7).alias("v"))
    got = running_totals(df, [("k", True), ("id", True)], {"c": F.col("v")}, n_ranges=5)
    w = Window.orderBy("k", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("c", F.sum("v").over(w))
    assert sorted(map(tuple, got.select("id", "c").collect())) == sorted(map(tuple, want.select("id", "c").collect()))


def test_readers_roundtrip(spark, tmp_path):
    from lodestar.sources import readers

    p = tmp_path / "spam.txt"
    p.write_text("1 2 3 0\n4 5 6 1\n")
    df = readers.read_delimited(spark, str(p), 4)
    rows = sorted((r.features, r.label) for r in df.collect())
    assert rows == [([1.0, 2.0, 3.0], 0), ([4.0, 5.0, 6.0], 1)]
    q = tmp_path / "digits.txt"
    q.write_text("7,0,255\n3,1,2\n")
    d2 = readers.read_labelled_rows(spark, str(q))
    assert sorted((r.label, r.features) for r in d2.collect()) == [(3, [1.0, 2.0]), (7, [0.0, 255.0])]


def test_index_and_training_set_sinks(spark, tmp_path):
    from lodestar.sources import readers, sinks

    idx = lsh.hash_table(derived.vectors(spark, SF_SMALL), 2, 2, 0.5, 64)
    lsh.write_index(idx, str(tmp_path / "idx"))
    back = lsh.read_index(spark, str(tmp_path / "idx"))
    assert back.count() == idx.count()
    lab = boxes.label_proposals(*reversed(derived.truth_and_proposals(spark, SF_SMALL)), ["img_id", "category_id"])
    sinks.write_training_set(lab.withColumn("split", F.lit("train")), str(tmp_path / "ts"))
    one = readers.read_partitioned(spark, str(tmp_path / "ts"), "train", 3)
    assert one.count() == lab.where("category_id = 3").count()


def test_bootstrap_has_no_upper_limit(spark):
    df = spark.range(400).withColumnRenamed("id", "k")
    for fraction in (0.5, 8.0, 100.0):
        n = sampling.bootstrap(df, "k", fraction, seed=3).groupBy("k").count()
        got = n.agg(F.sum("count"), F.sum(F.col("count") * F.col("count"))).first()
        mean, square = got[0] / 400, got[1] / 400
        assert abs(mean - fraction) < 5 * np.sqrt(fraction / 400)
        assert abs(square - mean * mean - fraction) < fraction / 2


def test_beta_shares_at_any_number_of_pulls():
    # whole parameters: the share below x is a binomial tail
    from math import comb

    for a, b, x in ((1, 1, 0.3), (3, 40, 0.05), (25, 4, 0.9), (60, 60, 0.5)):
        n = a + b - 1
        tail = sum(comb(n, j) * x ** j * (1 - x) ** (n - j) for j in range(a, n + 1))
        assert abs(events.beta_cdf([a], [b], [x])[0] - tail) < 1e-12
    for pulls in (1e3, 1e7, 1e9, 1e12):
        half = np.array([pulls / 2])
        assert abs(events.beta_cdf(half, half, np.array([0.5]))[0] - 0.5) < 1e-9
        skew = events.beta_cdf([pulls / 10], [pulls * 0.9], [0.1])[0]  # at the mean, 1/2 and a term in 1/sqrt(pulls)
        assert abs(skew - 0.5) < 1.0 / np.sqrt(pulls)
        sd = np.sqrt(0.25 / pulls)
        assert abs((events.beta_quantile(half, half, 0.975)[0] - 0.5) / sd - 1.959964) < 3e-3
    assert abs(events.beta_quantile(np.array([2.0]), np.array([1e9]), 0.5)[0] * 1e9 - 1.6783469900166608) < 1e-6


def test_pairs_of_single_ids_are_told_without_moving_them(spark):
    """First tables from the rows' own buckets, as from grouping all pairs; ids with several vectors take the other way."""
    v = derived.vectors(spark, SF_SMALL)
    v = v.unionByName(v.where("vec_id % 9 = 0")).unionByName(v.where("vec_id % 7 = 0").withColumn("v", F.transform("v", lambda x: -x)))
    idx = lsh.hash_table(v, 4, 2, 1.5, 64)
    want = {tuple(r) for r in lsh.candidate_pairs(idx, idx).select("query_id", "neighbour_id", "table_id").collect()}
    known = lsh.with_buckets(idx).cache()
    one = lsh.single_pairs(known, known, 4)
    got = [tuple(r) for part in (one, lsh.candidate_pairs(known.where("NOT single"), known), lsh.candidate_pairs(known.where("single"), known.where("NOT single")))
           for r in part.select("query_id", "neighbour_id", "table_id").collect()]
    assert len(got) == len(set(got)) and set(got) == want and one.count()
    assert "Aggregate" not in one._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
