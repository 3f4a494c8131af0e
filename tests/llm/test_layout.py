"""Mixing and sharding."""

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import mixing, sharding
from lodestar.session import table
from tests.conftest import SF_SMALL


def shared(sizes, weights=mixing.WEIGHTS, passes=3):
    """Targets by the rule itself: share by weight, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and free:
        total = sum(w[s] for s in free)
        for s in free:
            target[s] += left * w[s] / total
        left = 0.0
        for s in list(free):
            if target[s] >= passes * sizes[s]:
                left += target[s] - passes * sizes[s]
                target[s] = float(passes * sizes[s])
                free.discard(s)
    return target


def test_mix_meets_targets(spark, make_docs):
    rows = [(i, "w " * (i % 40), ["b", "a", "é", None, "tiny", "empty"][min(5, i % 9)]) for i in range(600)]
    rows = [(i, "" if s == "empty" else "w" if s == "tiny" else t, s) for i, t, s in rows]
    rows += [(7, "same row", "a")] * 50 + [(None, "x y z", "a"), (None, None, None), (900, "long " * 20000, "b")]
    got = mixing.mixed_documents(make_docs(rows), block=16).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = shared(sizes)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mixed_documents(make_docs(rows[::-1]).repartition(7), block=16).collect()))


def test_schedule_is_whole_and_even(spark, make_docs):
    docs = table(spark, SF_SMALL, "documents")
    rows = docs.selectExpr("doc_id", "source", "cast(n_chars as long) size")
    sources, pieces = mixing.mix(rows, block=64)
    n = sources.agg({"blocks": "sum"}).first()[0]
    slots = mixing.schedule(sources, n, True).toPandas()
    assert sorted(slots.slot) == list(range(n))
    for _, g in slots.sort_values("slot").groupby("index"):
        assert list(g["rank"]) == list(range(len(g)))
        # low discrepancy: every prefix holds the source's share to within a few slots
        assert abs(np.arange(1, len(g) + 1) - (g.slot.to_numpy() + 1) * len(g) / n).max() < 6
    words = pieces.where("slot is not null").groupBy("slot").sum("words").toPandas()["sum(words)"]
    assert (words <= 64).all() and (words == 64).sum() >= n - len(set(slots["index"]))


def test_mix_without_words(make_docs):
    assert mixing.mixed_documents(make_docs([])).count() == 0
    got = mixing.mixed_documents(make_docs([(1, "", "a"), (2, None, None), (None, " \n", "a")])).collect()
    assert len(got) == 3 and all(r.taken == 0 and r.target == 0 and r.size == 0 for r in got)


@given(st.integers(1, 5000), st.integers(0, 2 ** 40))
@settings(max_examples=40, deadline=None)
def test_permutation(n, seed):
    p = sharding.Permutation(n, seed)
    placed = p.place(np.arange(n))
    assert sorted(placed) == list(range(n))
    assert (p.row(placed) == np.arange(n)).all()


def test_shards(spark, make_docs):
    rows = [(i % 90 or None, ["é" * (i % 5), None, "same", ""][i % 4], "s") for i in range(200)] + [(1, "hot", "s")] * 3000
    got = sharding.shard_documents(make_docs(rows), 8).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert sharding.locate(r.row, len(rows), 8) == (r.shard, r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_documents(make_docs(rows[::-1]).repartition(5), 8).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert sharding.shard_documents(make_docs([])).count() == 0
