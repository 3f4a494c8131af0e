"""Quality by positive-unlabelled learning with the non-negative risk estimator."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches, slices, word_slices
from lodestar.llm.labelled import labelled_texts, remainder

#: Trusted positives, and unlabelled texts, that a model is fitted on at most.
FIT_ROWS = 4000
#: Nets whose values are averaged; each starts from other weights and sees the rows in another order.
NETS = 5
_KINDS = 9
_kind = np.zeros(256, dtype=np.int64)
for _i in range(256):
    _c = chr(_i)
    _kind[_i] = (1 if "a" <= _c <= "z" or _i >= 128 else 2 if "A" <= _c <= "Z" else 3 if "0" <= _c <= "9"
                 else 4 if _c == " " else 5 if _c == "\n" else 6 if _c in ".,;:'\"()-" else 7 if _c in "#*$%&|<>"
                 else 8 if _c in "!?" else 0)
N_FEATURES = _KINDS ** 3 + 6


def features(text: str | None) -> np.ndarray:
    """A text's shares of byte-kind trigrams (square roots), and how often its words and word runs repeat.

    A long text is read in slices whose figures are averaged by their number of bytes.
    """
    out = np.zeros(N_FEATURES)
    data = (text or "").encode()
    if not data:
        return out
    kinds = np.zeros(_KINDS ** 3)
    for at in range(0, len(data), 1 << 20):
        k = _kind[np.frombuffer(data[at:at + (1 << 20) + 2], dtype=np.uint8)]
        if len(k) > 2:
            kinds += np.bincount(k[:-2] * _KINDS * _KINDS + k[1:-1] * _KINDS + k[2:], minlength=_KINDS ** 3)
    n_words = weight = 0
    rest = np.zeros(4)
    for words in word_slices(data):
        if not words:
            continue
        h = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))
        _, counts = np.unique(h, return_counts=True)
        pairs, runs = h[:-1] * 31 + h[1:], h[:-3] * 31 + h[1:-2] * 37 + h[2:-1] * 41 + h[3:]
        size = sum(map(len, words))
        rest += size * np.array([len(counts) / len(h), counts.max() / len(h),
                                 len(np.unique(pairs)) / len(pairs) if len(pairs) else 1,
                                 len(np.unique(runs)) / len(runs) if len(runs) else 1])
        weight += size
        n_words += len(words)
    out[:-6] = np.sqrt(kinds / max(1.0, kinds.sum()))
    out[-6:-2] = rest / max(1, weight)
    out[-2:] = np.log1p(n_words), len(data) / max(1, n_words) / 10
    return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Scale:
    """Standard scores, held within 6."""

    def __init__(self, x: np.ndarray):
        self.mean, sd = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64)
        self.use = sd > 1e-6
        self.sd = sd[self.use]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x[:, self.use] - self.mean[self.use]) / self.sd, -6, 6)


class Net:
    """g(x): a linear part and a small tanh layer, moved by Adam steps along d risk / d g."""

    def __init__(self, width: int, hidden: int = 16, seed: int = 0):
        self.rng = np.random.default_rng(seed)
        self.w = [self.rng.normal(0, width ** -0.5, (width, hidden)), np.zeros(hidden),
                  self.rng.normal(0, 0.3, hidden), np.zeros(width), np.zeros(1)]
        self.m, self.v, self.t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + x @ self.w[3] + self.w[4]

    def step(self, x: np.ndarray, dg: np.ndarray, rate: float, decay: float = 1e-3) -> None:
        h = np.tanh(x @ self.w[0] + self.w[1])
        dh = dg[:, None] * self.w[2] * (1 - h * h)
        self.t += 1
        for i, g in enumerate((x.T @ dh + decay * self.w[0], dh.sum(0), h.T @ dg + decay * self.w[2],
                               x.T @ dg + decay * self.w[3], dg.sum(keepdims=True))):
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.999 * self.v[i] + 0.001 * g * g
            self.w[i] = self.w[i] - rate * (self.m[i] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[i] / (1 - 0.999 ** self.t)) + 1e-8)


def _rounds(rng, p: np.ndarray, u: np.ndarray, steps: int, batch: int = 256):
    """Batches of both sets, reshuffled every time through, until ``steps`` batches are made."""
    done = 0
    parts = max(1, max(len(p), len(u)) // batch)
    while done < steps:
        for a, b in zip(np.array_split(rng.permutation(len(p)), parts), np.array_split(rng.permutation(len(u)), parts)):
            if len(a) and len(b):
                yield p[a], u[b]
            done += 1


def class_prior(p: np.ndarray, u: np.ndarray, steps: int = 300, seed: int = 0) -> float:
    """The share of positives among the unlabelled, without any negative label.

    A net is taught to tell positives from unlabelled texts on one half of each.  On the other half,
    above any score, unlabelled texts are at least share * (positives there), and nearly that where no
    negative scores so high; so the ratio of the two tails is taken where it is smallest with three
    sampling errors added.
    """
    net, half = Net(p.shape[1], seed=seed), (len(p) // 2, len(u) // 2)
    if min(half) < 5:
        return 0.5
    for a, b in _rounds(net.rng, p[:half[0]], u[:half[1]], steps):
        x = np.r_[a, b]
        s = _sigmoid(net(x))
        net.step(x, np.r_[(s[:len(a)] - 1) / len(a), s[len(a):] / len(b)], 0.003)
    sp, su = np.sort(net(p[half[0]:])), np.sort(net(u[half[1]:]))
    at = np.quantile(sp, np.linspace(0, 0.7, 36))
    tail_p = 1 - np.searchsorted(sp, at) / len(sp)
    tail_u = 1 - np.searchsorted(su, at) / len(su)
    error = np.sqrt(tail_u * (1 - tail_u) / len(su) + tail_p * (1 - tail_p) / len(sp))
    best = int(np.argmin((tail_u + 3 * error) / tail_p))
    return float(np.clip(tail_u[best] / tail_p[best], 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 800, rate: float = 0.005, seed: int = 0):
    """(scale, nets, prior) that minimise the non-negative unbiased risk with the sigmoid loss.

    risk = prior * loss(P, +) + max(0, loss(U, -) - prior * loss(P, -)).  A batch whose second part is
    negative, which only over-fitting makes, takes a step back on that part instead.  The prior is the
    median of one estimate for each net.
    """
    scale = Scale(np.r_[positive, unlabelled])
    order = np.random.default_rng(seed)
    p, u = (scale(x[order.permutation(len(x))]).astype(np.float32) for x in (positive, unlabelled))
    prior = float(np.median([class_prior(p, u, seed=seed + i) for i in range(NETS)]))
    nets = []
    for i in range(NETS):
        net = Net(p.shape[1], seed=seed + i)
        for a, b in _rounds(net.rng, p, u, steps):
            x = np.r_[a, b]
            s = _sigmoid(net(x))
            slope = s * (1 - s)
            sp, su = s[:len(a)], s[len(a):]
            dp, du = slope[:len(a)] / len(a), slope[len(a):] / len(b)
            whole = su.mean() - prior * sp.mean() >= 0
            net.step(x, np.r_[-2 * prior * dp, du] if whole else np.r_[prior * dp, -du], rate)
        nets.append(net)
    return scale, nets, prior


class Model:
    """What the workers need to score a text: scale and weights, a few hundred kilobytes at most."""

    def __init__(self, scale: Scale | None, nets: list[Net], prior: float):
        self.scale, self.nets, self.prior = scale, nets, prior
        for net in nets:
            net.m, net.v = [], []

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.nets:
            return np.full(len(texts), self.prior)
        x = self.scale(np.array([features(t) for t in texts]))
        return _sigmoid(sum(net(x) for net in self.nets) / len(self.nets))


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, seed: int = 0) -> Model:
    """A model from at most ``rows`` trusted positives and about ``rows`` texts whose labels are not looked at.

    Labels come only from ids whose crc32 mod 3 is not 1, and only label 1 is used.  The unlabelled
    texts are a hash sample of the documents outside the held-out third.  With no positives or no
    other texts there is nothing to learn: every score is then 1, so nothing is rejected.
    """
    learn = remainder(F.col("_id"), 3) != 1
    marked = labelled_texts(docs, labels.where(F.col("quality") == 1), "quality", learn, (rows, rows), seed).select("_text")
    web = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).where(learn)
    n = web.count()
    part = min(1.0, 1.5 * rows / max(1, n))
    mix = F.xxhash64(F.lit(seed + 1), "_id", "_text")
    web = web.where(F.shiftrightunsigned(mix, 11).cast("double") < part * float(1 << 53)).orderBy(mix).limit(rows).select("_text")

    def make():
        def one(batch: pa.RecordBatch):
            return {"f": [features(t.as_py()).astype(np.float32).tobytes() for t in batch.column(0)]}
        return one

    def gathered(d: DataFrame) -> np.ndarray:
        """The features as 32-bit numbers: some three kilobytes a text, in an order that no partitioning changes."""
        parts = [np.frombuffer(f, dtype=np.float32) for f in sorted(bytes(r.f) for r in map_batches(d, "f binary", make).collect())]
        return np.array(parts).reshape(-1, N_FEATURES)

    p, u = gathered(marked), gathered(web)
    if not len(p) or not len(u):
        return Model(None, [], 1.0)
    return Model(*fit(p, u, seed=seed))


def _texts(column, limit: int = 256):
    for at in range(0, len(column), limit):
        yield [v.as_py() for v in column[at:at + limit]]


def quality_scores(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, held_out, score, predicted) of every row; only the text makes the score.

    Null and empty texts have all features 0 and are scored like any other.  Repeated rows and null
    ids stay; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col), F.col(text), (remainder(F.col(id_col), 3) == 1).alias("held_out"))

    def make():
        def one(batch: pa.RecordBatch):
            s = np.concatenate([model.score(t) for t in _texts(batch.column(1))])
            return {id_col: batch.column(0), "held_out": batch.column(2), "score": s, "predicted": (s >= 0.5).astype(np.int32)}
        return one

    return map_batches(d, f"`{id_col}` {kind}, held_out boolean, score double, predicted int", make)


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns, where they are read."""
    at = docs.columns.index(text)

    def run(batches):
        for batch in slices(batches):
            s = np.concatenate([model.score(t) for t in _texts(batch.column(at))])
            yield batch.filter(pa.array(s >= 0.5))

    return docs.mapInArrow(run, docs.schema)
