"""Importance resampling, centroid clustering and chat formatting against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import chat, clustering, resampling
from lodestar.session import table
from tests.conftest import SF_SMALL

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    return w, [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(rows, target):
    """(doc_id, n_features, weight, score, rank) by the rule, for (doc_id, text) rows."""
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(runs(text)[1])
    for text in target:
        t.update(runs(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in range(10000)]
    out = []
    for doc_id, text in rows:
        words, f = runs(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(fit[:25 * len(fit) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in out]


TEXTS = st.lists(st.text(st.sampled_from("aB9é{ ~\x7f\n日_Z"), max_size=40), max_size=8)


@given(TEXTS, st.integers(1, 60))
@settings(max_examples=150, deadline=None)
def test_buckets_of_texts(texts, size):
    old = resampling.SLICE
    resampling.SLICE = size
    try:
        got = defaultdict(list)
        for at, _, wr, w, pr, p in resampling.scans(pa.array(["skipped", *texts, None]).slice(1), 10000):
            for r, b in [*zip(wr, w), *zip(pr, p)]:
                got[at + r].append(int(b))
    finally:
        resampling.SLICE = old
    for i, text in enumerate(texts):
        assert sorted(got[i]) == sorted(runs(text)[1])
    assert len(texts) not in got


def test_long_words():
    texts = ["x" * n + " " + "é" * n for n in (1, 23, 24, 47, 48, 49, 500)]
    got = defaultdict(list)
    for at, _, wr, w, pr, p in resampling.scans(pa.array(texts), 10000):
        for r, b in [*zip(wr, w), *zip(pr, p)]:
            got[at + r].append(int(b))
    assert [sorted(got[i]) for i in range(len(texts))] == [sorted(runs(t)[1]) for t in texts]


def test_draw_matches_the_rule(spark, make_docs):
    docs = table(spark, SF_SMALL, "documents")
    bench = table(spark, SF_SMALL, "benchmark")
    got = resampling.importance_ranks(docs.repartition(5), bench).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()])
    assert sorted(map(tuple, got), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])


def test_draw_with_repeats_nulls_and_ties(spark, make_docs):
    words = "one two three four five six seven eight nine ten " * 3
    rows = [(i, f"{words} {i % 7}", "s") for i in range(120)] + [(5000, words * 2, "s")] * 300 + [(None, words, "s")] * 9
    rows += [(None, None, None), (1, "", "s"), (2, "Short", None), (3, words.upper() + "Ä" * 70, "t"), (3, words.upper() + "Ä" * 70, "u")]
    bench = spark.createDataFrame([(1, "six seven eight", 9), (2, None, 9)], "item_id long, text string, score long")
    got = sorted(map(tuple, resampling.importance_ranks(make_docs(rows).repartition(7), bench).collect()), key=repr)
    assert got == sorted(brute([(i, t) for i, t, _ in rows], ["six seven eight", None]), key=repr)
    again = resampling.importance_ranks(make_docs(rows[::-1]).coalesce(1), bench).collect()
    assert got == sorted(map(tuple, again), key=repr)
    whole = resampling.resample(make_docs(rows), bench)
    assert whole.columns == make_docs([]).columns
    drawn = Counter(r[0] for r in got if r[4] is not None)
    assert Counter(r.doc_id for r in whole.collect()) == drawn


@pytest.mark.parametrize("rows", [[], [(1, "a b", "s")], [(1, None, None)]])
def test_draw_of_nothing(spark, make_docs, rows):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = resampling.importance_ranks(make_docs(rows), bench).collect()
    assert [r["rank"] for r in got] == [None] * len(rows)
    assert resampling.resample(make_docs(rows), bench).count() == 0


@given(st.lists(st.integers(-3, 3), min_size=1, max_size=40), st.data())
@settings(max_examples=60, deadline=None)
def test_kth_key(values, data):
    keys = np.array([values, [v * v for v in values], list(range(len(values)))], dtype=np.int64)
    k = data.draw(st.integers(0, len(values) - 1))
    ranked = sorted(map(tuple, keys.T.tolist()))
    assert tuple(resampling._kth(keys, k)) == ranked[k]
    less, same = resampling._compare(keys, ranked[k])
    assert less.sum() == k and same.sum() == 1


@pytest.mark.parametrize("parts", [1, 6])
def test_cutoff_is_exact(spark, parts):
    rng = np.random.default_rng(3)
    rows = [tuple(int(v) for v in r) for r in np.column_stack([rng.integers(-4, 4, 400), rng.integers(0, 2, 400), rng.integers(0, 3, 400),
                                                               np.zeros(400), np.zeros(400)])]
    keys = spark.createDataFrame(rows, "down long, nil long, id long, k1 long, k2 long").repartition(parts).cache()
    for k in (1, 37, 200, 400):
        key = sorted(rows)[k - 1]
        assert resampling.cutoff(keys, k) == (list(key), sum(r < key for r in rows), rows.count(key))
    with pytest.raises(ValueError):
        resampling.cutoff(keys, 401)


# ---- clustering ----

def kmeans(rows):
    """vec_id → (cluster, distance, …) by the rule, for (vec_id, vector) rows that are distinct."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:16]
    centres = [list(v) for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(3):
        members = defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        for n, vs in members.items():
            centres[n] = [sum(x) // len(vs) for x in zip(*vs)]
    placed = [(i, *near(v)[::-1]) for i, v in kept]
    own = Counter()
    for _, c, d in placed:
        own[c] += d
    return sorted([(i, c, d, own[c], sum(own.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for i, c, d in placed], key=repr)


def test_clusters_match_the_rule(spark):
    e = table(spark, SF_SMALL, "embeddings")
    got = sorted(map(tuple, clustering.clusters(e.repartition(3)).collect()), key=repr)
    assert got == kmeans([(r.vec_id, r.embedding) for r in e.collect()])


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    schema = "vec_id long, embedding array<double>, cluster string, v string"
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 64)], "c", "x") for i in range(60)]
    rows += [(7, rows[3][1], "c", "x")] * 40 + [(None, [0.5] * 64, None, None), (None, [0.25] * 64, None, None)]
    bad = [(900, None, "c", "x"), (901, [1.0] * 63, "c", "x"), (902, [], "c", "x"), (903, [None] + [1.0] * 63, "c", "x"),
           (904, [float("nan")] + [1.0] * 63, "c", "x"), (905, [float("-inf")] + [1.0] * 63, "c", "x")]
    got = sorted(map(tuple, clustering.clusters(spark.createDataFrame(rows + bad, schema).repartition(4)).collect()), key=repr)
    assert got == kmeans([r[:2] for r in rows + bad])
    few = sorted(map(tuple, clustering.clusters(spark.createDataFrame(rows[:3], schema)).collect()), key=repr)
    assert few == kmeans([r[:2] for r in rows[:3]])
    assert clustering.clusters(spark.createDataFrame(bad, schema)).count() == 0
    assert clustering.clusters(spark.createDataFrame([], schema)).count() == 0
    huge = clustering.clusters(spark.createDataFrame([(1, [1e300] * 64, "", ""), (2, [-1e300] * 64, "", "")], schema)).collect()
    assert [r.distance for r in huge] == [0, 0]


@given(st.integers(0, 10 ** 6), st.integers(1, 20), st.integers(1, 9), st.sampled_from([1, 2, 8, 64]))
@settings(max_examples=60, deadline=None)
def test_progressive_search(seed, rows, k, n):
    rng = np.random.default_rng(seed)
    v, c = rng.integers(-3, 4, (rows, n)), rng.integers(-3, 4, (k, n))
    d = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    centre, dist = clustering.nearest(clustering.transform(v), clustering.transform(c))
    assert (centre == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()
    t = clustering.transform(v)
    assert (t[:, 0] == v.sum(axis=1)).all() and ((t ** 2).sum(axis=1) == n * (v ** 2).sum(axis=1)).all()


# ---- chat ----

PLANTED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def figures(rows, template=chat.Template()):
    """Figures of each conversation, from the texts themselves and one rendering of the whole."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        messages = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in messages if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(messages), sha("".join(f"{r}\n{t}\n" for r, t in messages)), len(loss), sha(loss), len(template(messages))))
    return sorted(out, key=repr)


def test_chat_figures(spark):
    c = table(spark, SF_SMALL, "conversations")
    got = sorted(map(tuple, chat.digests(c.repartition(5)).collect()), key=repr)
    assert got == figures([(r.conv_id, r.turn, r.role, r.text) for r in c.collect()] + PLANTED)


ODD = ["", None, "\\", "[INST]", "[\\INST]", "</s>", " [/INST]", "\\[ANS] ", "<s>\n\n", "é日\U0001f600" * 30, "[TURN] x [SAYS] y [/TURN]", "0", "1", "</s", "[/"]


def test_chat_odd_turns_and_a_long_conversation(spark):
    rows = [(i % 3, i, ["user", "assistant", "system", "tool [SAYS] \\", None][i % 5], ODD[i % len(ODD)]) for i in range(90)]
    rows += [(None, None, "assistant", "a"), (None, 0, "assistant", "b"), (4, 1, "user", "same")] + [(4, 1, "assistant", "same")] * 3
    rows += [(77, i // 2, ["user", "assistant"][i % 2], f"{i} {ODD[i % len(ODD)]}") for i in range(2000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, piece string, chunk int")
    got = sorted(map(tuple, chat.digests(df.repartition(6), chunk=64).collect()), key=repr)
    assert got == figures(rows + PLANTED)
    small = sorted(map(tuple, chat.digests(df, chunk=8, memory=3).collect()), key=repr)
    assert small == got


def test_chat_of_nothing_and_a_second_minus_one(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert [tuple(r) for r in chat.digests(spark.createDataFrame([], schema)).collect()] == figures(PLANTED)
    got = chat.digests(spark.createDataFrame([(-1, 5, "user", "x")], schema)).collect()
    assert sorted(map(tuple, got)) == sorted(figures([(-1, 5, "user", "x")]) + figures(PLANTED))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[SAYS]"]),
                          st.lists(st.sampled_from([*chat.Template.CONTROL, "\\", "a", " ", "\n", "<", "["]), max_size=6).map("".join)), max_size=6))
@settings(max_examples=150, deadline=None)
def test_template_reads_back(messages):
    t = chat.Template()
    out = t(messages)
    assert t.read(out) == messages
    found = chat.spans(t, messages)
    assert "".join(s.piece for s in found) == (out if messages else "")
    assert [t.unescape(s.piece[s.start:s.stop]) for s in found] == [text for _, text in messages]
    assert all(s.keeps for s in found)


def test_templates_that_rewrite_history(spark):
    def last_user_carries_system(messages):
        """The system's text moves into the last user turn, as some published templates have it."""
        system = "".join(t for r, t in messages if r == "system")
        turns = [m for m in messages if m[0] != "system"]
        last = max((i for i, m in enumerate(turns) if m[0] == "user"), default=-1)
        return "".join(f"({r}:{system if i == last else ''}{t})" for i, (r, t) in enumerate(turns))

    talk = [("system", "S"), ("user", "u1"), ("assistant", "a1"), ("user", "u2")]
    assert [s.keeps for s in chat.spans(last_user_carries_system, talk)] == [True, True, True, False]
    df = spark.createDataFrame([(1, i, r, t, False) for i, (r, t) in enumerate(talk)], "conv_id long, turn long, role string, text string, added boolean")
    assert chat.format_turns(df, last_user_carries_system).first().rewrites == [3]
    assert chat.format_turns(df, chat.Template()).first().rewrites == []


def test_prefixes_are_whole(spark):
    def first_turn_marks_the_last(messages):
        """The first text moves into the last turn if it is a system's, however many turns lie between."""
        first = messages[0][1] if messages[0][0] == "system" else ""
        return "".join(f"({r}:{first if i == len(messages) - 1 else ''}{t})" for i, (r, t) in enumerate(messages))

    talk = [("system", "S")] + [(["user", "assistant"][i % 2], f"t{i}") for i in range(39)]
    assert [s.keeps for s in chat.spans(first_turn_marks_the_last, talk)] == [True] + [False] * 39
    df = spark.createDataFrame([(1, i, r, t, False) for i, (r, t) in enumerate(talk)], "conv_id long, turn long, role string, text string, added boolean")
    assert chat.format_turns(df, first_turn_marks_the_last).first().rewrites == list(range(1, 40))
    cut = chat.format_turns(df, first_turn_marks_the_last, chunk=8).orderBy("chunk").collect()
    assert [8 * r.chunk + i for r in cut for i in r.rewrites] == list(range(1, 40))
