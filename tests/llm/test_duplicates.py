"""SimHash and embedding near-duplicates against brute force."""

import math

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from lodestar.llm import covertree, queries, simhash
from lodestar.operators.network import connected
from lodestar.session import table
from tests.conftest import SF_SMALL


def groups_of(nodes, linked):
    """Component of each node by plain search."""
    nodes, comp = list(nodes), {}
    for n in sorted(nodes):
        if n in comp:
            continue
        todo, comp[n] = [n], n
        while todo:
            x = todo.pop()
            for y in linked(x):
                if y not in comp:
                    comp[y] = n
                    todo.append(y)
    return comp


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_components_of_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 500)] + [(5000, 4999), (5000, 5000)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1500), 1000), 4999: 4999, 5000: 4999}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_golay_code_is_perfect():
    code, word = simhash.Golay(), np.arange(1 << 23)
    i = code.index(word)
    assert np.bitwise_count(word ^ (i << 11 | code.parity[i])).max() == 3


def test_keys_find_all_within_reach():
    rng, code = np.random.default_rng(3), simhash.Golay()
    for n in range(400):
        a = rng.integers(0, 1 << 64, dtype=np.uint64)
        b = a
        for bit in rng.choice(64, n % 5, replace=False):
            b ^= np.uint64(1) << np.uint64(bit)
        row, key = simhash.keys(np.array([a, b]), code)
        assert set(key[row == 0]) & set(key[row == 1])


@pytest.mark.parametrize("slice_bytes", [40, 1 << 20])
def test_fingerprint(monkeypatch, slice_bytes):
    monkeypatch.setattr(simhash, "word_slices", lambda d, f=simhash.word_slices: f(d, slice_bytes))
    for t in ["", None, "one", "A b", "a b c", "a b c d", "É é X y Z w", "the  \t same\n words here again and again the same words"]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


@pytest.mark.parametrize("block", [64, simhash.BLOCK])
def test_links_connect_what_distance_connects(spark, block):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 64, 40, dtype=np.uint64)
    fps = set(map(int, base))
    for b in base[:6]:  # clusters, one of them large
        for _ in range(400 if b == base[0] else 30):
            x = int(b)
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    fps = sorted(fps)
    want = groups_of(fps, lambda x: [y for y in fps if (x ^ y).bit_count() <= 4])
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    made = simhash.links(df, block=block).collect()
    back = lambda x: x % (1 << 64)
    near = {}
    for r in made:
        near.setdefault(back(r.a), []).append(back(r.b))
        near.setdefault(back(r.b), []).append(back(r.a))
    assert groups_of(fps, lambda x: near.get(x, [])) == want


def expected_documents(rows):
    fp = [plain_fingerprint(t) for _, t in rows]
    root = groups_of(set(fp), lambda x: [y for y in set(fp) if (x ^ y).bit_count() <= 4])
    least = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return [(i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, fp)]


def test_simhash_documents(spark, make_docs):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    rows += [(1000, None), (999, ""), (None, ""), (7, rows[7][1]), (7, rows[7][1]), (None, "alone in null"), (None, "x" * 3000)]
    rows += [(2000 + i, "Copy of one TEXT that many share") for i in range(300)]
    got = simhash.near_duplicates(make_docs([(i, t, None) for i, t in rows])).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected_documents(rows)))
    kept = simhash.keep_one(make_docs([(i, t, None) for i, t in rows])).collect()
    want = expected_documents(rows)
    roots = {f: c for _, f, c in want}
    ids = sorted(r.doc_id for r in kept if r.doc_id is not None)
    assert ids == sorted({c for c in roots.values() if c is not None})
    assert len([r for r in kept if r.doc_id is None]) == len({f for f, c in roots.items() if c is None})
    assert simhash.near_duplicates(make_docs([])).count() == 0 and simhash.keep_one(make_docs([])).count() == 0


SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("unit", T.StringType())])


def expected_vectors(rows):
    ok, unit = {}, {}
    for n, (i, x, label) in enumerate(rows):
        u = covertree.unit_vector(x)
        if u is not None and label is not None:
            ok[n], unit[n] = (label, len(u)), np.frombuffer(u)
    near = {n: [m for m in ok if m != n and ok[m] == ok[n] and float(unit[n] @ unit[m]) >= 0.98] for n in ok}
    root = groups_of(range(len(rows)), lambda n: near.get(n, []))
    least = {}
    for n, (i, _, _) in enumerate(rows):
        if i is not None:
            least[root[n]] = min(i, least.get(root[n], i))
    return sorted((repr((i, len(near.get(n, [])), least.get(root[n]) if n in ok else i,
                         i == (least.get(root[n]) if n in ok else i))) for n, (i, _, _) in enumerate(rows)))


@pytest.mark.parametrize("cell,block,fit", [(2048, 4096, 8192), (60, 32, 8192), (40, 4096, 8192), (60, 32, 64), (60, 32, 1)])
def test_cover_tree(spark, monkeypatch, cell, block, fit):
    monkeypatch.setattr(covertree, "FIT_ROWS", fit)
    monkeypatch.setattr(covertree, "CELL", cell)
    monkeypatch.setattr(covertree, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for label in (1, 2, None):
        for c in rng.normal(size=(12, 8)):
            for _ in range(20):
                rows.append((i, (c + rng.normal(scale=0.12 * np.linalg.norm(c) / 3, size=8)).astype("float32").tolist(), label))
                i += 1
    rows += [(i + k, rows[0][1], 1) for k in range(150)]  # a common vector
    i += 150
    rows += [(i, [2 * v for v in rows[0][1]], 1), (i + 1, [0.0] * 8, 1), (i + 2, None, 1), (i + 3, [float("nan")] * 8, 1), (i + 4, [], 1),
             (i + 5, [1.0, None] + [0.0] * 6, 1), (i + 6, [1.0, 2.0], 1), (i + 7, [1e30, 1e30], 1), (None, rows[30][1], 1), (5, rows[5][1], 1)]
    got = covertree.near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    assert sorted(repr(tuple(r)) for r in got) == expected_vectors(rows)
    assert covertree.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cover_tree_prunes_and_covers():
    rng = np.random.default_rng(0)
    c = rng.normal(size=(40, 16))
    x = np.repeat(c, 50, axis=0) + rng.normal(scale=0.02, size=(2000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = covertree.CoverTree(x, covertree.chord(0.98))
    assert sorted(np.concatenate(tree.members)) == list(range(2000))
    assert all(len(a) <= len(b) and list(a) == list(b[:len(a)]) for a, b in zip(tree.centres, tree.centres[1:]))
    found = list(covertree.leaf_pairs(tree, tree, covertree.chord(0.98)))
    leaves = len(tree.members)
    assert len(found) < leaves * leaves / 8
    met = {(int(p), int(q)) for i, j in found for p in tree.members[i] for q in tree.members[j]}
    a, b = np.nonzero(x @ x.T >= 0.98)
    assert set(zip(a.tolist(), b.tolist())) <= met


def test_cover_tree_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    want = con.execute(queries.ORACLE["op2_covertree"]).fetchall()
    got = queries.op2_covertree(spark, SF_SMALL).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert math.isclose(covertree.chord(0.98), 0.2)
