"""Quality, toxicity, repetition and LM scoring: held-out accuracy, brute force and defined odd cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import quality, queries, repetition, scoring, toxicity
from lodestar.session import table
from tests.conftest import SF_MID, SF_SMALL

ODD = [(5001, None, "s"), (5002, "", "s"), (None, "no id at all", None), (5003, "word", "s"), (5004, "x" * 50_000, "s"), (5004, "x" * 50_000, "s"),
       (5005, "long text " * 30_000, "s")]


def auc(score, label):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(len(score))
    ones = label == 1
    return (rank[ones].mean() - (ones.sum() - 1) / 2) / (~ones).sum()


@pytest.mark.parametrize("name,label,modulus,held,least", [("op9_quality", "quality", 3, 1, 0.95), ("op4_toxicity", "toxic", 5, 0, 0.6)])
def test_classifier_on_held_out_rows(spark, name, label, modulus, held, least):
    got = queries.QUERIES[name](spark, SF_MID).toPandas()
    assert len(got) == table(spark, SF_MID, "documents").count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % modulus == held for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    m = got.merge(table(spark, SF_MID, "labels").toPandas(), on="doc_id")
    m = m[m.held_out]
    assert auc(m.score.to_numpy(), m[label].to_numpy()) > least


@pytest.mark.parametrize("module,scores,keep", [(quality, "quality_scores", "keep_good"), (toxicity, "toxicity_scores", "keep_civil")])
def test_classifier_odd_rows(spark, make_docs, module, scores, keep):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    model = module.train(docs, labels)
    odd = make_docs(ODD)
    got = getattr(module, scores)(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    by_text = dict.fromkeys(r.doc_id for r in got)
    assert sorted(by_text, key=repr) == sorted({i for i, _, _ in ODD}, key=repr)
    assert next(r.score for r in got if r.doc_id == 5001) == next(r.score for r in got if r.doc_id == 5002)
    kept = getattr(module, keep)(odd, model)
    assert kept.schema == odd.schema
    rejected = 0 if module is quality else 1
    assert kept.count() == sum(r.predicted != rejected for r in got)
    assert getattr(module, scores)(make_docs([]), model).count() == 0
    none = labels.where("false")
    assert getattr(module, scores)(odd, module.train(docs, none)).count() == len(ODD)
    assert getattr(module, keep)(odd, module.train(docs, none)).count() == len(ODD)
    assert getattr(module, keep)(odd, module.train(make_docs([]), labels)).count() == len(ODD)


def test_class_prior_is_found_without_negatives():
    rng = np.random.default_rng(0)
    pos = rng.normal(1, 1, (3000, 5))
    web = np.r_[rng.normal(1, 1, (2100, 5)), rng.normal(-1.5, 1, (900, 5))]
    rng.shuffle(web)
    assert abs(quality.class_prior(pos, web) - 0.7) < 0.08


def test_quality_features_of_slices_agree():
    text = "Some words, and 12 more!\n" * 60_000  # more than one slice
    assert np.allclose(quality.features(text)[:-6], quality.features(text[:25 * 20_000])[:-6], atol=1e-2)
    assert not quality.features(None).any()


def brute_repeats(ids, doc):
    out = []
    for i in range(len(ids)):
        best = 0
        for j in range(len(ids)):
            k = 0
            while i != j and max(i, j) + k < len(ids) and doc[i + k] == doc[i] == doc[j + k] and ids[i + k] == ids[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def test_repeats_match_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n = int(rng.integers(1, 45))
        ids, doc = rng.integers(0, rng.integers(1, 6), n), np.sort(rng.integers(0, 3, n))
        assert repetition.repeats(ids, doc).tolist() == brute_repeats(ids, doc)


def brute_figures(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)

    def inside(k):
        runs = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
        again = {r for r in runs if runs.count(r) > 1}
        return len({j for i, r in enumerate(runs) if r in again for j in range(i, i + k)})

    longest = max(brute_repeats(words, [0] * len(words)), default=0)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, inside(8), inside(5), longest)


def test_repetition_rules(spark, make_docs):
    line = "one two three four five six seven eight nine ten"
    rows = [(1, f"{line}\n{line}\n\n \n \nend", "s"), (2, "é# *$ %&|<> é", None), (3, None, None), (4, "", "s"), (None, " ".join(map(str, range(60))), "s"),
            (5, "a b " * 200, "s"), (5, "a b " * 200, "s"), (6, " ".join(map(str, range(100))) + " " + " ".join(map(str, range(30))), "s"),
            (7, " ".join(map(str, [*range(400), *range(60), *range(500, 700)])), "s")]
    rows += [(100 + r.doc_id, r.text[:600], "s") for r in table(spark, SF_SMALL, "documents").limit(40).collect()]
    got = repetition.quality_rules(make_docs(rows)).collect()
    want = []
    for i, t, _ in rows:
        f = brute_figures(t)
        failed = f[0] < 20 or 100 * f[4] > 30 * f[0]
        kept = not failed and not (f[5] > 0.35 * f[0] or f[6] > 50 and f[6] > 0.2 * f[0])
        want.append((i, *f[:5], failed, kept, *f[5:]))
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, want))
    assert repetition.quality_rules(make_docs([])).count() == 0


def test_gradient_of_the_network():
    rng = np.random.default_rng(1)
    net = scoring.Net(rng.normal(0, 0.3, len(scoring.Net().flat)))
    row, place, _ = scoring.padded([rng.integers(0, scoring.SIZE, 30).astype(np.int32), rng.integers(0, 5, 9).astype(np.int32)])
    g = net.gradient(row, place)
    for i in rng.choice(np.flatnonzero(np.abs(g) > 1e-4), 25, replace=False):
        loss = []
        for d in (1e-2, -1e-2):
            w = net.flat.astype(np.float64)
            w[i] += d
            loss.append(-scoring.Net(w).log_probs(row, place).mean())
        assert abs((loss[0] - loss[1]) / 2e-2 - g[i]) < 2e-3 + 0.05 * abs(g[i])


def test_pseudo_likelihood(spark, make_docs):
    docs = table(spark, SF_SMALL, "documents")
    tokens, net = scoring.train(docs)
    counts = {}
    for r in docs.collect():
        for w in r.text.encode().lower().split():
            counts[w] = counts.get(w, 0) + 1
    assert list(tokens.known) == sorted(counts, key=lambda w: (-counts[w], w))[:scoring.WORDS]
    rows = [(r.doc_id, r.text, "s") for r in docs.limit(20).collect()] + ODD
    got = {}
    for r in scoring.pseudo_likelihood(make_docs(rows), tokens, net).collect():
        got.setdefault(r.doc_id, r)
    for i, t, _ in rows[:20] + [(5003, "word", None), (None, "no id at all", None)]:
        ids = tokens.of(t)
        total = 0.0
        for at in range(len(ids)):
            h = net.shift.astype(float).copy()
            for k, o in enumerate(scoring.OFFSETS):
                h += net.inputs[k, ids[at + o] if 0 <= at + o < len(ids) else scoring.SIZE]
            h, (group, member) = np.tanh(h), divmod(int(ids[at]), scoring.GROUP)
            for z, own in ((h @ net.top + net.top_bias, group), (h @ net.within[group] + net.bias[group], member)):
                total += z[own] - z.max() - np.log(np.exp(z - z.max()).sum())
        assert got[i].n_tokens == len(ids) and abs(got[i].log_likelihood - total) < 1e-3 * max(1, abs(total))
    assert got[5001].n_tokens == 0 and got[5001].log_likelihood == 0 and got[5001].perplexity is None
    # the probabilities of all tokens at one place add up to one
    ids = tokens.of(rows[0][1])[:9]
    every = np.concatenate([scoring.padded([np.where(np.arange(len(ids)) == 4, k, ids).astype(np.int32)])[0] for k in range(scoring.SIZE)])
    place = np.arange(scoring.SIZE) * (len(ids) + 2 * scoring.SIDE) + scoring.SIDE + 4
    assert abs(np.exp(net.log_probs(every, place)).sum() - 1) < 1e-4
    # both sides matter: a text in its order is likelier than the same words shuffled
    row, place, _ = scoring.padded([tokens.of(t) for _, t, _ in rows[:20]])
    mixed_row, mixed_place, _ = scoring.padded([np.random.default_rng(0).permutation(tokens.of(t)) for _, t, _ in rows[:20]])
    assert net.log_probs(row, place).mean() > net.log_probs(mixed_row, mixed_place).mean()
    assert scoring.pseudo_likelihood(make_docs([]), *scoring.train(make_docs([]))).count() == 0


def test_remainder_of_null_id(spark):
    from lodestar.llm.labelled import remainder

    r = spark.sql("select cast(null as long) i").select(remainder(F.col("i"), 5).alias("r")).first()
    assert r.r == 0


def test_word_numbers_by_bytes_match_words():
    frequent = [b"the", b"of", b"eightlet", b"a longer word".replace(b" ", b""), b"alongerwork", "é".encode(), b"x"]
    tokens = scoring.Tokens(frequent)
    for text in ["", None, " \t\n", "The of  x\x0bX", "eightlet eightlett eightle alongerword alongerwork alongerwore", "é É the\x1c the", "x" * 40 + " x",
                 "the " * 5000 + "alongerword"]:
        words = (text or "").encode().lower().split()
        ids = tokens.of(text).tolist()
        assert len(ids) == len(words)
        assert all(i == frequent.index(w) if w in frequent else scoring.WORDS <= i < scoring.SIZE for w, i in zip(words, ids))
    assert tokens.of("same other same")[0] == tokens.of("other same")[1]
    zero = scoring.Tokens([b"the", b"of\x00", b"of"])  # a zero byte at the end is a letter of its own
    assert zero.of("the the\x00 of\x00 of")[0] == 0 and zero.of("the\x00")[0] >= scoring.WORDS
    assert zero.of("of\x00")[0] == 1 and zero.of("of")[0] >= scoring.WORDS


def test_training_does_not_depend_on_how_files_are_split(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    means = []
    for parts in (1, 24):
        d = docs.repartition(parts)
        tokens, net, shares = scoring.train_words(d)
        got = scoring.pseudo_likelihood(d, tokens, net, shares=shares).agg({"log_likelihood": "sum", "n_tokens": "sum"}).first()
        means.append(got["sum(log_likelihood)"] / got["sum(n_tokens)"])
    assert abs(means[0] - means[1]) < 0.05, means


def test_the_table_of_shares_is_bounded(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), 10 + i % 50) for i in range(1000)], "word binary, n long")
    old, scoring.SHARED_WORDS = scoring.SHARED_WORDS, 100
    try:
        least = scoring.least_count(counts)
        assert least == 55 and len(scoring.word_shares(counts, scoring.Tokens([])).key) == 100
    finally:
        scoring.SHARED_WORDS = old
    assert scoring.least_count(counts) == scoring.LEAST


def test_passes_predict_every_word():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, scoring.SIZE, n).astype(np.int32) for n in (1, 2, 7, 0, 5000, 33, 9000)]
    seen = set()
    for phase in range(scoring.PASSES):
        learner = scoring.Learner(scoring.Net().flat, phase)
        owners = []

        def gradient(tokens, place):
            # places of a buffer as (document, word) pairs
            for p in place:
                before = 0
                for d in owners[-1]:
                    start = before + scoring.SIDE
                    if start <= p < start + len(docs[d]):
                        seen.add((d, int(p - start)))
                    before = start + len(docs[d])
            return np.zeros(len(learner.net.flat), dtype=np.float32)

        learner.net.gradient = gradient
        waiting = []
        for d in rng.permutation(len(docs)):  # each pass meets the documents in another layout
            waiting.append(d)
            owners.append(list(waiting))
            learner.add(docs[d])
            if not learner.held:
                waiting = []
        owners.append(list(waiting))
        learner.learn()
    assert seen == {(d, i) for d, ids in enumerate(docs) for i in range(len(ids))}


def test_labelled_sample_takes_each_id_once(spark, make_docs):
    from lodestar.llm.labelled import labelled_texts

    rows = [(i, f"text {i}", "s") for i in range(1, 41)] + [(7, f"copy {i % 3}", "s") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i < 10)) for i in range(1, 41)], "doc_id long, toxic int")

    def chosen(docs):
        return sorted(tuple(r) for r in labelled_texts(docs, labels, "toxic", F.lit(True), (20, 9)).collect())

    got = chosen(make_docs(rows))
    assert len(got) == 29 and len({i for i, _, _ in got}) == 29 and sum(label for _, _, label in got) == 9
    assert chosen(make_docs(rows[::-1]).repartition(5)) == got


def test_longest_repeat_alone_rejects(spark, make_docs):
    own, passage = [f"w{i}" for i in range(20_000)], [f"p{i}" for i in range(2_800)]
    rows = [(1, " ".join(own[:7_000] + passage + own[7_000:14_400] + passage), "s"),  # 28 % covered
            (2, " ".join(own[:7_000] + passage[:200] + own[7_000:14_400] + passage[:200]), "s"),
            (3, " ".join(own[:7_000] + passage[:201] + own[7_000:] + passage[:201]), "s")]
    got = {r.doc_id: r for r in repetition.quality_rules(make_docs(rows)).collect()}
    assert not any(r.base_failed for r in got.values()) and got[1].n_covered <= 0.35 * got[1].n_words
    assert {i: r.kept for i, r in got.items()} == {1: False, 2: True, 3: False}


def test_words_of_a_class_have_their_own_cost(spark, make_docs):
    docs = table(spark, SF_MID, "documents")
    tokens, net, shares = scoring.train_words(docs)
    counts = {}
    for r in docs.collect():
        for w in r.text.encode().lower().split():
            counts[w] = counts.get(w, 0) + 1
    assert len(shares.key) == sum(n >= scoring.LEAST and w not in tokens.known for w, n in counts.items()) > 0

    def cost(words):
        data = b" ".join(words)
        return shares.of(data, tokens.of(data.decode()))

    known = [w for w, n in counts.items() if n >= scoring.LEAST and w not in tokens.known]
    cls = tokens.of(b" ".join(known).decode())
    for c in range(scoring.WORDS, scoring.SIZE):  # shares and what is left over for other words make 1
        mine = [w for w, k in zip(known, cls) if k == c]
        left = np.exp(shares.rest[c - scoring.WORDS])
        assert abs(np.exp(cost(mine)).sum() + left - 1) < 1e-4
    # random letters of the same class cost more than the class's real word
    rng = np.random.default_rng(0)
    noise = [bytes(rng.integers(97, 123, len(w)).astype(np.uint8)) for w in known for _ in range(20)]
    kinds = tokens.of(b" ".join(noise).decode())
    worst = {c: min(v for v, k in zip(cost(known), cls) if k == c) for c in set(cls.tolist())}
    unmet = [(v, worst[k]) for w, v, k in zip(noise, cost(noise), kinds.tolist()) if w not in counts and k in worst and len(w) > 3]
    assert len(unmet) > 20 and np.mean([v < real for v, real in unmet]) > 0.95
    # a text's figure has the cost of its words on top of that of their classes
    rows = [(r.doc_id, r.text, "s") for r in docs.limit(20).collect()] + ODD
    plain, whole = ({r.doc_id: r for r in scoring.pseudo_likelihood(make_docs(rows), tokens, net, shares=s).collect()} for s in (None, shares))
    for i, t, _ in rows:
        words = (t or "").encode().lower().split()
        want = plain[i].log_likelihood + (cost(words).sum() if words else 0)
        assert abs(whole[i].log_likelihood - want) < 1e-6 * max(1, abs(want))
    assert scoring.pseudo_likelihood(make_docs([]), *scoring.train_words(make_docs([]))[:2]).count() == 0


def test_toxic_phrases_of_ordinary_words():
    rng = np.random.default_rng(0)
    words = np.array([f"w{i:03d}".encode() for i in range(600)])
    phrases = rng.permutation(words).reshape(-1, 6)

    def doc(toxic):
        if toxic:
            return b"\n".join(b" " + b" ".join(p) + b" " for p in phrases[rng.choice(100, 10, replace=False)])
        return b"\n".join(b" " + b" ".join(w) + b" " for w in rng.choice(words, 60, replace=False).reshape(-1, 6))

    made = toxicity.dictionaries([(doc(i % 2), i % 2) for i in range(400)])
    assert all(plain != toxic for plain, toxic in made)
    c = toxicity.Compressors(made)
    gains = [[c.gains(doc(label).split(b"\n")).mean() for _ in range(40)] for label in (0, 1)]
    assert np.mean(gains[1]) > np.mean(gains[0]) + 0.5, gains


def test_whole_texts_are_measured_in_any_parts():
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}".encode() for i in range(900)])
    c = toxicity.Compressors([(b" ".join(words[:300]), b" ".join(words[300:600])), (b" ".join(words[:200]), b" ".join(words[400:600]))])
    texts = [" ".join(w.decode() for w in rng.choice(words, n)) for n in (0, 1, 5, 6, 7, 400, 30_000)] + [None, "", " \n", "W1 w1 W1"]
    together = toxicity.summaries(texts, c.gains)
    plain = [toxicity._compressor(d) for pair in [(b" ".join(words[:300]), b" ".join(words[300:600])), (b" ".join(words[:200]), b" ".join(words[400:600]))] for d in pair]
    for text, got in zip(texts, together):
        assert got == toxicity.summaries([text], c.gains)[0]
        g = np.array([(len(plain[0].compress(w)) - len(plain[1].compress(w)) + len(plain[2].compress(w)) - len(plain[3].compress(w))) / 2
                      for run in toxicity.windows(text) for w in run])
        t = toxicity.Tally()
        t.add(g)
        assert np.allclose(t.summary(), got)
    assert toxicity.summaries([], c.gains) == []
    old, toxicity.REMEMBERED = toxicity.REMEMBERED, 10
    try:  # forgetting changes nothing
        assert toxicity.summaries(texts[::-1], c.gains) == together[::-1]
    finally:
        toxicity.REMEMBERED = old


def test_texts_are_numbered_together_as_alone(monkeypatch):
    tokens = scoring.Tokens([b"the", b"internationalisation", b"of", b"a\0"])
    texts = ["the end of", None, "", "  \n", "Internationalisation", "a\0 a x", "of " * 50, "the", ""]
    alone = [tokens.of(t).tolist() for t in texts]
    assert [len(a) for a in alone] == [3, 0, 0, 0, 1, 3, 50, 1, 0]
    monkeypatch.setattr(scoring, "SLICE_BYTES", 40)
    assert [ids.tolist() for ids in tokens.of_all(texts)] == alone
