"""The pipeline's stages against plain Python on the same rows."""

import zlib
from collections import Counter, defaultdict

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from lodestar.llm import bpe, mixing, quality, simhash, toxicity
from lodestar.llm.common import row_key
from lodestar.session import table
from tests.conftest import SF_SMALL
from tests.llm.test_duplicates import groups_of, plain_fingerprint
from tests.llm.test_layout import shared


def test_stages_by_hand(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    labels = table(spark, SF_SMALL, "labels")
    rows = {r.doc_id: r for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5

    good = stage[names[0]](spark, docs, SF_SMALL)
    assert good.columns == docs.columns
    model = quality.train(docs, labels)
    assert {r.doc_id for r in good.collect()} == {i for i, r in rows.items() if model.score([r.text])[0] >= 0.5}

    civil = stage[names[1]](spark, good, SF_SMALL)
    score = toxicity.train(docs, labels).scorer()
    kept = {i for i in (r.doc_id for r in good.collect()) if score([rows[i].text])[0] < 0.5}
    assert {r.doc_id for r in civil.collect()} == kept

    civil.write.parquet(str(tmp_path / "civil"))
    civil = spark.read.parquet(str(tmp_path / "civil"))
    fp = {i: plain_fingerprint(rows[i].text) for i in kept}
    group = groups_of(set(fp.values()), lambda x: [y for y in set(fp.values()) if (x ^ y).bit_count() <= 4])
    first = {}
    for i, f in fp.items():
        first[group[f]] = min(i, first.get(group[f], i))
    one = stage[names[2]](spark, civil, SF_SMALL)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(first.values())

    mixed = stage[names[3]](spark, one, SF_SMALL)
    assert mixed.columns == docs.columns
    words = {i: len(rows[i].text.encode().split()) for i in first.values()}
    sizes, longest = Counter(), defaultdict(int)
    for i, n in words.items():
        sizes[rows[i].source] += n
        longest[rows[i].source] = max(longest[rows[i].source], n)
    taken = Counter(r.doc_id for r in mixed.collect())
    assert max(taken.values()) <= 3
    want = shared(dict(sizes))
    for s in sizes:
        assert abs(sum(n * words[i] for i, n in taken.items() if rows[i].source == s) - want[s]) <= 1.5 * longest[s]

    got = stage[names[4]](spark, mixed, SF_SMALL).collect()
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter({(i, len(enc.encode_ordinary(rows[i].text))): n for i, n in taken.items()})


def test_odd_rows_pass_the_stages(spark, make_docs):
    odd = make_docs([(1, None, None), (None, "", "a"), (None, None, "a"), (2, "w " * 40_000, "a"), (3, "same words here", None), (3, "same words here", None)])
    assert simhash.keep_one(odd).count() == 3
    mixed = mixing.mixed_copies(odd)
    assert mixed.columns == odd.columns and mixed.where(F.col("text").isNull()).count() == 0
    empty = make_docs([])
    for made in (simhash.keep_one(empty), mixing.mixed_copies(empty)):
        assert made.columns == empty.columns and made.count() == 0


def test_rows_that_differ_in_a_map_only_are_two(spark):
    docs = spark.sql("SELECT 1L doc_id, 'a b c d e' text, 's' source, map('k', 1) extra, named_struct('a', map(1, 2)) deep "
                     "UNION ALL SELECT 1L, 'a b c d e', 's', map('k', 2), named_struct('a', map(1, 2))")
    assert simhash.keep_one(docs).count() == 1
    k = docs.select(*[c.alias(n) for c, n in zip(row_key(docs), "ab")])
    assert k.distinct().count() == 2
    assert mixing.mixed_copies(docs).columns == docs.columns


def test_run_matches_its_stages_and_itself(spark):
    a = corpus_pipeline.run(spark, SF_SMALL).collect()
    b = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert a and Counter(a) == Counter(b)
    assert all(zlib.crc32(str(r.doc_id).encode()) >= 0 and len(r.ids_sha256) == 64 for r in a)
