"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import (bpe, chat, clustering, counting, covertree, mixing, quality, repetition, resampling, scoring, sharding,
                          simhash, toxicity)
from lodestar.session import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


def op2_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links and its group."""
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                       public_tokenizers.PATTERN)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, labels))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and its group."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The masked pseudo-log-likelihood of every document, by a network trained on all of them."""
    docs = table(spark, sf_dir, "documents")
    tokens, net, shares = scoring.train_words(docs)
    return scoring.pseudo_likelihood(docs, tokens, net, shares=shares)


def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition figures and the verdict on every document."""
    return repetition.quality_rules(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return counting.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.quality_scores(docs, quality.train(docs, labels))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its weight towards the benchmark's text, and its rank in the draw."""
    return resampling.importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its cluster."""
    return clustering.clusters(table(spark, sf_dir, "embeddings"))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, with figures read back from the output."""
    return chat.digests(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_mixing, op2_covertree, op3_bpe, op4_toxicity, op5_simhash, op6_lm_scoring, op7_repetition,
                                  op8_token_counts, op9_quality, op10_sharding, op11_resampling, op12_clustering, op13_chat, pipeline)}

ORACLE = {
    "op2_covertree": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        ok AS (
            SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(x) > 0
                AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND list_dot_product(x, x) > 0),
        pairs AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
            WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.98),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v
            UNION
            SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n_links FROM pairs GROUP BY a)
        SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, least.component_id, v.vec_id = least.component_id AS kept
        FROM v LEFT JOIN n ON n.a = v.vec_id JOIN least ON least.a = v.vec_id""",
    "op11_resampling": r"""
        WITH steps AS (
            SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda a, i:
                CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS step),
        texts AS (
            SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
        words AS (
            SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
        counted AS (
            SELECT side, id, feature, count(*) AS n FROM (
                SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM words)
            GROUP BY ALL),
        hashed AS (
            SELECT feature, xor(list_reduce(range(octet_length(encode(feature))), lambda a, i:
                xor(a >> 8, step[xor(a & 255, CAST('0x' || substr(hex(encode(feature)), 2 * i + 1, 2) AS BIGINT)) + 1]), 4294967295), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT feature FROM counted), steps),
        shares AS (
            SELECT b AS bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
            FROM range(10000) r(b) LEFT JOIN hashed ON bucket = b LEFT JOIN counted USING (feature) GROUP BY b),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM shares) + 10000)
                / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM shares) + 10000)))) AS BIGINT) AS gain FROM shares),
        sums AS (
            SELECT id, sum(n) AS n_features, sum(n * gain) AS total FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket)
            WHERE side = 'd' GROUP BY id),
        weighed AS (
            SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
                CAST(coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS BIGINT) AS weight,
                CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h
            FROM documents JOIN words ON side = 'd' AND words.id = doc_id LEFT JOIN sums ON sums.id = doc_id),
        scored AS (
            SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weighed),
        ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
        SELECT scored.doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op12_clustering": """
        WITH kept AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        c0 AS (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v FROM kept
            QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= 16),
        a0 AS (
            SELECT vec_id, kept.v, c0.c, list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - c0.v[i]) ** 2)) AS d
            FROM kept, c0 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c0.c) = 1),
        m0 AS (
            SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
                SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a0, range(1, 65) r(i) GROUP BY c, i)),
        c1 AS (
            SELECT c, coalesce(moved, v) AS v FROM c0 LEFT JOIN (SELECT c, list(x ORDER BY i) AS moved FROM m0 GROUP BY c) USING (c)),
        a1 AS (
            SELECT vec_id, kept.v, c1.c, list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - c1.v[i]) ** 2)) AS d
            FROM kept, c1 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c1.c) = 1),
        m1 AS (
            SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
                SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a1, range(1, 65) r(i) GROUP BY c, i)),
        c2 AS (
            SELECT c, coalesce(moved, v) AS v FROM c1 LEFT JOIN (SELECT c, list(x ORDER BY i) AS moved FROM m1 GROUP BY c) USING (c)),
        a2 AS (
            SELECT vec_id, kept.v, c2.c, list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - c2.v[i]) ** 2)) AS d
            FROM kept, c2 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c2.c) = 1),
        m2 AS (
            SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
                SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a2, range(1, 65) r(i) GROUP BY c, i)),
        c3 AS (
            SELECT c, coalesce(moved, v) AS v FROM c2 LEFT JOIN (SELECT c, list(x ORDER BY i) AS moved FROM m2 GROUP BY c) USING (c)),
        a3 AS (
            SELECT vec_id, kept.v, c3.c, list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - c3.v[i]) ** 2)) AS d
            FROM kept, c3 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c3.c) = 1)
        SELECT vec_id, CAST(a3.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a3.c) AS BIGINT) AS cluster_inertia,
            CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
        FROM a3 JOIN c3 ON c3.c = a3.c""",
    "op13_chat": r"""
        WITH control(mark) AS (
            VALUES ('<s>'), ('</s>'), ('[INST]'), ('[/INST]'), ('[ANS]'), ('[SYS]'), ('[/SYS]'), ('[TURN]'), ('[SAYS]'), ('[/TURN]')),
        rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
            VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        sized AS (
            SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
                + (SELECT sum((length(text) - length(replace(text, mark, ''))) // length(mark)) FROM control)
                + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 WHEN 'system' THEN 13 ELSE 23 + length(role) END AS chars FROM rows)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id""",
}
