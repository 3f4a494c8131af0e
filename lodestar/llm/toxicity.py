"""Toxicity by compression distance: which of two dictionaries makes a window shorter."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches, slices, word_slices
from lodestar.llm.labelled import labelled_texts, remainder
from lodestar.session import cut_lineage

#: Labelled ordinary and toxic documents that a model is fitted on at most; the more ordinary text there is, the surer
#: that a word is the toxic class's own.
FIT_ROWS = (5000, 1500)
#: Windows of a document that dictionaries are trained on at most, those with the smallest hashes; the calibration reads all.
FIT_WINDOWS = 250
#: Words of a window.
WINDOW = 6
#: Bytes of a dictionary's part of its own class, and of the part that both share.
OWN_BYTES, SHARED_BYTES = 2048, 4096
#: Pairs of dictionaries whose gains are averaged; each is trained on another draw of the same documents.
PAIRS = 3
LEVEL = 4
#: A toxic document that is let through weighs as much as so many ordinary ones that are stopped.
MISS = 2.0
#: Bytes that a window must be shorter by with the toxic dictionary to count at each step.
STEPS = (2, 3, 4, 5, 6, 7, 8, 10)


def windows(text: str | None):
    """Lists of windows: runs of words in lower case (ASCII), one space around and between them."""
    for words in word_slices((text or "").encode().lower()):
        yield [b" " + b" ".join(words[i:i + WINDOW]) + b" " for i in range(0, len(words), WINDOW)]


def _sample(text: str | None) -> bytes:
    """The windows that a document gives to the fit, one on each line."""
    kept: list[bytes] = []
    for run in windows(text):
        kept += run
        if len(kept) > 4 * FIT_WINDOWS:
            kept = sorted(kept, key=zlib.crc32)[:FIT_WINDOWS]
    return b"\n".join(sorted(kept, key=zlib.crc32)[:FIT_WINDOWS] if len(kept) > FIT_WINDOWS else kept)


class Vocabulary:
    """Numbers for the words of the sample, and for the stems of each word, so that inflected forms count together."""

    def __init__(self, docs: list[bytes]):
        number: dict[bytes, int] = {}
        self.docs = [np.unique(np.array([number.setdefault(w, len(number)) for w in d.split()], dtype=np.int32)) for d in docs]
        self.words = list(number)
        self.crc = np.array(list(map(zlib.crc32, self.words)), dtype=np.uint64)
        stems: dict[bytes, int] = {}
        self.stems = np.array([[stems.setdefault(s, len(stems)) for s in (w, w[:4] + b"*", w[:5] + b"*", w[:6] + b"*")]
                               for w in self.words], dtype=np.int32).reshape(-1, 4)
        self.n_stems = len(stems)

    def unlike(self, chosen: list[int], seed: int) -> list[int]:
        """Those of the ``chosen`` documents that are no near copies of an earlier one, which would pass a copied text
        off as usage of its class: pairs that share a band of minimum hashes and over 0.4 of their words."""
        rng = np.random.default_rng(seed)
        mult = rng.integers(1, 1 << 31, 24, dtype=np.uint64) | np.uint64(1)
        met: dict[tuple, list[int]] = {}
        out = []
        for i in chosen:
            mine = self.docs[i]
            if not len(mine):
                continue
            least = ((self.crc[mine][:, None] * mult) & np.uint64(0xFFFFFFFF)).min(0).reshape(-1, 3).tolist()
            bands = [(n, *band) for n, band in enumerate(least)]
            near = {j for band in bands for j in met.get(band, ())}
            shared = {j: len(np.intersect1d(mine, self.docs[j], assume_unique=True)) for j in near}
            if any(k > 0.4 * (len(mine) + len(self.docs[j]) - k) for j, k in shared.items()):
                continue
            for band in bands:
                met.setdefault(band, []).append(i)
            out.append(i)
        return out

    def used(self, chosen: list[int]) -> np.ndarray:
        """How many of the ``chosen`` documents use each stem."""
        n = np.zeros(self.n_stems, dtype=np.int64)
        for i in chosen:
            n[np.unique(self.stems[self.docs[i]])] += 1
        return n


def _own_stems(mine: np.ndarray, n_mine: int, other: np.ndarray, n_other: int, least: float = 15.0) -> np.ndarray:
    """Which stems far more documents of a class use than its size explains (likelihood ratio, 8 times the share)."""
    share = (mine + other) / max(1, n_mine + n_other)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = 2 * (np.where(mine > 0, mine * np.log(mine / (n_mine * share)), 0)
                     + np.where(other > 0, other * np.log(other / (n_other * share)), 0))
    return (mine > 2) & (mine * n_other >= 8 * other * n_mine) & (ratio > least)


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """The content of a dictionary that zstandard trains on ``samples``, its best parts last."""
    if sum(map(len, samples)) > 2 * size and len(samples) > 8:
        try:
            return zstandard.train_dictionary(size + 400, samples, k=128, d=8, f=18, accel=1).as_bytes()[-size:]
        except zstandard.ZstdError:  # too little variety to train on
            pass
    return b"".join(dict.fromkeys(samples))[-size:]


def _packed(words: list[bytes]) -> list[bytes]:
    return [b" " + b" ".join(words[i:i + 64]) + b" " for i in range(0, len(words), 64)]


def _drawn(rng: random.Random, doc: bytes) -> list[bytes]:
    """Up to 30 windows of a document."""
    lines = doc.split(b"\n") if doc else []
    return rng.sample(lines, min(len(lines), 30))


def dictionaries(docs: list[tuple[bytes, int]], pairs: int = PAIRS, seed: int = 0) -> list[tuple[bytes, bytes]]:
    """Pairs (ordinary, toxic) of dictionary contents trained on windows of labelled documents.

    Each is trained on what is typical of its class (own words; for ordinary text, words that several
    ordinary and no toxic documents use), followed by one part trained on windows of both, so that
    usual text is shortened equally and the difference in length shows the class alone.  Both have
    equal size.  The pairs differ in the draws of words and windows.  Where the toxic class has no words
    of its own, both are trained on windows of their class as they stand, so that phrases and order count.
    """
    vocabulary = Vocabulary([d for d, _ in docs])
    sets = {k: vocabulary.unlike([i for i, (_, label) in enumerate(docs) if label == k], seed) for k in (0, 1)}
    used = {k: vocabulary.used(sets[k]) for k in (0, 1)}
    own = _own_stems(used[1], len(sets[1]), used[0], len(sets[0]))[vocabulary.stems].any(axis=1)
    word = vocabulary.stems[:, 0]
    wanted = {1: own, 0: (used[0][word] > 1) & (used[1][word] == 0)}
    made = []
    for member in range(pairs):
        rng = random.Random(seed * 1000 + member)
        usual = []
        for d, _ in docs:
            usual += _drawn(rng, d)
        rng.shuffle(usual)
        shared = _dictionary(usual[:60_000], SHARED_BYTES)
        text: dict[int, list[bytes]] = {0: [], 1: []}
        for label, chosen in sets.items():
            for i in chosen:
                found = vocabulary.docs[i][wanted[label][vocabulary.docs[i]]].tolist()
                text[label] += _packed([vocabulary.words[n] for n in rng.sample(found, min(len(found), 400))])
        if not text[1]:
            for label, chosen in sets.items():
                text[label] = [w for i in chosen for w in _drawn(rng, docs[i][0])]
        for label in text:
            rng.shuffle(text[label])
        toxic = _dictionary(text[1][:6000], OWN_BYTES)
        plain = _dictionary(text[0][:6000], max(1, len(toxic)))
        size = min(len(toxic), len(plain))
        made.append((plain[-size:] + shared, toxic[-size:] + shared) if size else (shared, shared))
    return made


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """A compressor with a dictionary and without frame extras."""
    d = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)


#: Windows that are compressed in one call, and windows whose gains a worker remembers; then it starts anew.
GROUP, REMEMBERED = 4096, 30_000


class Compressors:
    """Pairs of compressors, made once in a worker; a window met again lately is not compressed again."""

    def __init__(self, contents: list[tuple[bytes, bytes]]):
        self.pairs = [(_compressor(plain), _compressor(toxic)) for plain, toxic in contents]
        self.known: dict[bytes, float] = {}

    def gains(self, run: list[bytes]) -> np.ndarray:
        """Bytes by which the toxic dictionaries make each window shorter, on average over the pairs."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        new = list(dict.fromkeys(w for w in run if w not in known))
        if new:
            total = np.zeros(len(new))
            for plain, toxic in self.pairs:
                total += _sizes(plain, new) - _sizes(toxic, new)
            known.update(zip(new, (total / len(self.pairs)).tolist()))
        return np.array([known[w] for w in run])


def _sizes(compressor: zstandard.ZstdCompressor, run: list[bytes]) -> np.ndarray:
    """Compressed length of each window."""
    return np.fromiter(map(len, compressor.multi_compress_to_buffer(run, threads=0)), dtype=np.int64, count=len(run))


class Tally:
    """What the thresholds are set on: windows over each step as number and share, the largest and the mean gain of a text."""

    def __init__(self):
        self.over, self.n, self.most, self.total = np.zeros(len(STEPS)), 0, 0.0, 0.0

    def add(self, g: np.ndarray) -> None:
        if len(g):
            self.over += [(g >= s).sum() for s in STEPS]
            self.n, self.most, self.total = self.n + len(g), max(self.most, float(g.max())), self.total + float(g.sum())

    def summary(self) -> list[float]:
        return [*np.log1p(self.over), *(self.over / (self.n + 8.0)), self.most, math.log1p(self.n), self.total / max(1, self.n)]


def summaries(texts: Iterable[str | None], gains) -> list[list[float]]:
    """The summary of every whole text, read one after the other; windows of several texts are compressed together, those of a
    long one in parts."""
    tallies: list[Tally] = []
    held, owner, waiting = [], [], 0

    def flush():
        g = gains([w for run in held for w in run])
        for i, part in zip(owner, np.split(g, np.cumsum([len(run) for run in held])[:-1])):
            tallies[i].add(part)

    for i, text in enumerate(texts):
        tallies.append(Tally())
        for run in windows(text):
            for at in range(0, len(run), GROUP):
                held.append(run[at:at + GROUP])
                owner.append(i)
                waiting += len(held[-1])
                if waiting >= GROUP:
                    flush()
                    held, owner, waiting = [], [], 0
    if held:
        flush()
    return [t.summary() for t in tallies]


class Logistic:
    """Calibration: logistic regression by Newton steps on standard scores."""

    def __init__(self, x: np.ndarray, y: np.ndarray, decay: float = 2e-3):
        self.mean, self.sd = x.mean(0), x.std(0) + 1e-9
        z = self._scaled(x)
        self.w = np.zeros(z.shape[1])
        keep = np.diag([decay] * (len(self.w) - 1) + [1e-9])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(y) + keep, z.T @ (p - y) / len(y) + keep @ self.w)
            self.w -= np.clip(step, -2, 2)

    def _scaled(self, x):
        return np.c_[np.clip((x - self.mean) / self.sd, -8, 8), np.ones(len(x))]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._scaled(np.atleast_2d(x)) @ self.w, -30, 30)))


class Model:
    """Dictionary contents and calibration, some tens of kilobytes; without them, one score for all."""

    def __init__(self, contents: list[tuple[bytes, bytes]] | None, calibrated: Logistic | None, rate: float):
        self.contents, self.calibrated, self.rate = contents, calibrated, rate

    def scorer(self):
        """A function from texts to their scores."""
        if self.contents is None:
            return lambda texts: [self.rate for _ in texts]
        c = Compressors(self.contents)

        def score(texts: Iterable[str | None]) -> list[float]:
            found = summaries(texts, c.gains)
            return self.calibrated(np.array(found)).tolist() if found else []

        return score


def measured(marked: DataFrame, contents: list[list[tuple[bytes, bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    """(summaries, labels) of the labelled texts (_text, _label, _fold), each read whole and measured with its fold's dictionaries."""
    got = []
    for fold, own in enumerate(contents):  # a task holds the dictionaries of one fold

        def make(own=own):
            c = Compressors(own)
            return lambda batch: {"x": summaries((t.as_py() for t in batch.column(0)), c.gains), "label": batch.column(1)}

        part = marked.where(F.col("_fold") == fold).select("_text", "_label")
        got += map_batches(part, "x array<double>, label int", make).collect()  # 19 numbers a labelled row
    got.sort(key=lambda r: (r.label, r.x))
    return np.array([r.x for r in got]), np.array([r.label for r in got], dtype=float)


def train(docs: DataFrame, labels: DataFrame, rows: tuple[int, int] = FIT_ROWS, folds: int = 3, seed: int = 0) -> Model:
    """A model from at most ``rows`` labelled documents (ordinary, toxic).

    Labels come only from ids whose crc32 mod 5 is not 0.  Dictionaries are trained on a sample of each document's windows, those
    with the smallest hashes.  The calibration is learnt across folds over whole texts, as scoring reads them: each fold
    is measured with dictionaries trained on the others, so thresholds do not rest on text that a dictionary has
    seen.  The final dictionaries are trained on all.  With one class only, the score of every text is that class's label.
    """
    marked = labelled_texts(docs, labels, "toxic", remainder(F.col("_id"), 5) != 0, rows, seed)
    marked = cut_lineage(marked.withColumn("_fold", F.pmod(F.xxhash64(F.lit(seed + 1), "_id"), F.lit(folds)).cast("int")))

    def make():
        def one(batch: pa.RecordBatch):
            return {"w": [_sample(t.as_py()) for t in batch.column(0)], "label": batch.column(1), "fold": batch.column(2)}
        return one

    got = map_batches(marked.select("_text", "_label", "_fold"), "w binary, label int, fold int", make).collect()
    sample = sorted(((bytes(r.w), r.label, r.fold) for r in got), key=lambda d: (zlib.crc32(d[0]), d[0], d[1]))
    del got
    met = Counter(label for _, label, _ in sample)
    if len(met) < 2:
        return Model(None, None, float(sample[0][1]) if sample else 0.0)
    contents = [dictionaries([(w, label) for w, label, own in sample if own != f], seed=seed) for f in range(folds)]
    calibrated = Logistic(*measured(marked, contents))
    # a class's share in the sample is not its share in the corpus, so the calibration is weighed back
    seen = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
    seen = seen.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    shares = {int(r[0]): r[1] for r in seen.groupBy("toxic").count().collect()}
    calibrated.w[-1] += math.log(MISS * shares[1] / shares[0]) - math.log(met[1] / met[0])
    return Model(dictionaries([(w, label) for w, label, _ in sample], seed=seed), calibrated, 0.0)


def toxicity_scores(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, held_out, score, predicted) of every row; only the text makes the score.

    Null and empty texts have no windows and get the calibrated score of none.  Repeated rows and
    null ids stay; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col), F.col(text), (remainder(F.col(id_col), 5) == 0).alias("held_out"))

    def make():
        score = model.scorer()

        def one(batch: pa.RecordBatch):
            s = score(t.as_py() for t in batch.column(1))
            return {id_col: batch.column(0), "held_out": batch.column(2), "score": s, "predicted": [int(v >= 0.5) for v in s]}
        return one

    return map_batches(d, f"`{id_col}` {kind}, held_out boolean, score double, predicted int", make)


def keep_civil(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with all their columns, where they are read.

    Null and empty texts have no windows and get the calibrated score of none; equal rows get one score each and stay or go
    together; an empty table stays empty.
    """
    at = docs.columns.index(text)

    def run(batches):
        score = model.scorer()
        for batch in slices(batches):
            yield batch.filter(pa.array([s < 0.5 for s in score(t.as_py() for t in batch.column(at))], type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
