"""LM scoring: masked pseudo-likelihood with a window network that sees both sides of every token."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import SLICE_BYTES, SPACE, map_batches, slices, word_slices
from lodestar.operators.partials import array_sums
from lodestar.session import cut_lineage

#: Frequent words with a number of their own, and hash classes (a power of two) that all other words fall in.
WORDS, CLASSES = 896, 128
#: Numbers of one group: the network first tells the group of a word, then the word in its group.
GROUP = 32
#: Words on each side that the network sees, and its hidden units.
SIDE, HIDDEN = 2, 32
#: Passes over the corpus; each predicts one word in ``EVERY`` and sees all others as context.  There is a pass for
#: each place modulo ``EVERY`` in a document, so that every word is predicted.
PASSES = EVERY = 1
#: Tokens of a training step, and of a slice when scoring; a slice's values stay in the processor's cache.
STEP, SLICE = 4096, 16384
RATE = 0.12
#: Tokens of a block: each block learns from the weights of the pass, and the blocks' weights are averaged.  Tasks are
#: merged until they hold a block, so how far a block learns does not depend on how files are split.
BLOCK = 1 << 20
#: Distinct words that a task counts before it hands the counts on.
COUNTED = 300_000
#: Occurrences from which a word outside the frequent ones has a share of its own; all rarer words are spelled.
LEAST = 10
#: Words with a share of their own at most, by a higher count than ``LEAST`` where the corpus has more; the table of
#: shares is sent to every task, so it has a bound.
SHARED_WORDS = 1 << 20
#: Taken off the count of each word with a share, for words that were not counted.
DISCOUNT = 0.75

SIZE = WORDS + CLASSES
GROUPS = SIZE // GROUP
_IS_SPACE = np.isin(np.arange(256), list(SPACE))
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_gap = re.compile(rb"[\x20\x09-\x0d]")
OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]


def _cuts(data: bytes):
    """``data`` in parts of about ``SLICE_BYTES``, cut between words."""
    at = 0
    while at < len(data):
        cut = _gap.search(data, at + SLICE_BYTES) if at + SLICE_BYTES < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def _spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the words of ``raw``, which ends with a space."""
    gap = _IS_SPACE.take(raw)
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.r_[0, edge]
    return edge[0::2], edge[1::2] - edge[0::2]


class Tokens:
    """Words (ASCII lower case) to numbers: frequent words first, then the hash classes; ``SIZE`` is beyond an end.

    A word's first eight bytes are one number, looked up among those of the frequent words; the few
    that match a frequent word of over eight bytes are compared whole.  The class of any other word
    is a mix of its first and last bytes and its length.
    """

    def __init__(self, frequent: list[bytes]):
        self.known = {w: i for i, w in enumerate(frequent)}
        # of words that differ by zero bytes at the end alone, the more frequent one has a number
        short = {int.from_bytes(w, "little"): (i, len(w)) for w, i in sorted(self.known.items(), key=lambda k: -k[1]) if len(w) <= 8}
        self.short = np.array(sorted(short), dtype=np.uint64)
        self.number = np.array([short[int(c)][0] for c in self.short], dtype=np.int32)
        self.size = np.array([short[int(c)][1] for c in self.short], dtype=np.int64)
        self.long = np.unique(np.array([int.from_bytes(w[:8], "little") for w in self.known if len(w) > 8], dtype=np.uint64))

    def of(self, text: str | None) -> np.ndarray:
        return next(self.of_all([text]))

    def of_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The numbers of each text; short texts go through the tables together."""
        held, waiting = [], 0
        for text in texts:
            data = (text or "").encode().lower()
            if waiting + len(data) > SLICE_BYTES:
                yield from self._joined(held)
                held, waiting = [], 0
            if len(data) > SLICE_BYTES:
                yield np.concatenate([self._slice(part) for part in _cuts(data)])
            else:
                held.append(data)
                waiting += len(data) + 1
        yield from self._joined(held)

    def _joined(self, held: list[bytes]) -> Iterator[np.ndarray]:
        if held:
            data = b" ".join(held)
            raw = np.frombuffer(data + b" " * 9, dtype=np.uint8)
            spans = _spans(raw)
            ids = self._numbers(data, raw, *spans)
            ends = np.searchsorted(spans[0], np.cumsum([len(d) + 1 for d in held])).tolist()
            yield from (ids[a:b] for a, b in zip([0, *ends], ends))

    def _slice(self, data: bytes) -> np.ndarray:
        raw = np.frombuffer(data + b" " * 9, dtype=np.uint8)
        return self._numbers(data, raw, *_spans(raw))

    def _numbers(self, data: bytes, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        code = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))[start]
        code &= _LOW[np.minimum(size, 8)]
        mixed = (code ^ raw[start + size - 1].astype(np.uint64) ^ (size.astype(np.uint64) << np.uint64(8))) * np.uint64(0x9E3779B97F4A7C15)
        ids = (WORDS + (mixed >> np.uint64(65 - CLASSES.bit_length()))).astype(np.int32)
        if len(self.short):
            place = np.minimum(np.searchsorted(self.short, code), len(self.short) - 1)
            hit = (self.short[place] == code) & (self.size[place] == size)  # a zero byte at the end is not padding
            ids[hit] = self.number[place[hit]]
        if len(self.long):
            for i in np.flatnonzero((size > 8) & np.isin(code, self.long)):
                ids[i] = self.known.get(data[start[i]:start[i] + size[i]], ids[i])
        return ids


def padded(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, place, doc): documents in one row with ``SIDE`` pads around each, and the places of the real tokens."""
    pad = np.full(SIDE, SIZE, dtype=np.int32)
    tokens = np.concatenate([pad, *(x for d in docs for x in (d, pad))])
    sizes = np.array([len(d) for d in docs])
    doc = np.repeat(np.arange(len(docs)), sizes)
    place = np.arange(len(doc)) + SIDE * (doc + 1)
    return tokens, place, doc


class Net:
    """log p(token | words on both sides): a table of hidden inputs for each offset, tanh, and a softmax of two levels.

    A token's probability is that of its group times that of the token in its group, both from the hidden layer, so all tokens'
    add up to one, and a token costs the columns of two short softmaxes instead of one long.
    """

    SHAPES = ((len(OFFSETS), SIZE + 1, HIDDEN), (HIDDEN,), (HIDDEN, GROUPS), (GROUPS,), (GROUPS, HIDDEN, GROUP), (GROUPS, GROUP))

    def __init__(self, weights: np.ndarray | None = None, seed: int = 0):
        counts = [int(np.prod(s)) for s in self.SHAPES]
        if weights is None:
            weights = np.random.default_rng(seed).normal(0, 0.1, sum(counts))
        self.flat = np.array(weights, dtype=np.float32)
        parts = np.split(self.flat, np.cumsum(counts)[:-1])
        self.inputs, self.shift, self.top, self.top_bias, self.within, self.bias = (p.reshape(s) for p, s in zip(parts, self.SHAPES))

    def start_from(self, counts: np.ndarray) -> None:
        """Biases that give every token its share of the corpus, so that training starts from there on however many tasks."""
        each = np.log(counts.reshape(GROUPS, GROUP) + 0.5)
        whole = np.log(np.exp(each).sum(axis=1))
        self.top_bias[:] = whole - whole.max()
        self.bias[:] = each - whole[:, None]

    def hidden(self, tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
        h = np.repeat(self.shift[None, :], len(place), axis=0)
        row = np.empty_like(h)
        for table, o in zip(self.inputs, OFFSETS):
            np.take(table, tokens[place + o], axis=0, out=row, mode="clip")
            h += row
        return np.tanh(h, out=h)

    @staticmethod
    def _softmax(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(exponentials, their sums) of raw scores; rows are only shifted when some are too large for 32 bits."""
        if z.size and z.max() > 60:
            z = z - z.max(1, keepdims=True)
        e = np.exp(z)
        return e, e.sum(axis=1)

    @staticmethod
    def _grouped(own: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """(order by group, the stretch of it that each group met takes)."""
        group = (own // GROUP).astype(np.int8 if GROUPS < 128 else np.int16)
        ends = np.cumsum(np.bincount(group, minlength=GROUPS))
        return np.argsort(group, kind="stable"), [(g, slice(a, b)) for g, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends)) if b > a]

    def log_probs(self, tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The log-probability of the token at each place, which itself is masked."""
        h, own = self.hidden(tokens, place), tokens[place]
        e, total = self._softmax(h @ self.top + self.top_bias)
        out = np.log(e[np.arange(len(own)), own // GROUP] / total).astype(np.float64)
        order, groups = self._grouped(own)
        h, sorted_own = np.take(h, order, axis=0), own[order]
        e, total = self._softmax(self._members(h, sorted_own, groups))
        out[order] += np.log(e[np.arange(len(own)), sorted_own % GROUP] / total)
        return out

    def _members(self, h: np.ndarray, own: np.ndarray, groups: list[tuple[int, slice]]) -> np.ndarray:
        """Raw scores of the tokens of each row's group, for rows sorted by group."""
        z = np.empty((len(own), GROUP), dtype=h.dtype)
        for g, part in groups:
            np.matmul(h[part], self.within[g], out=z[part])
        z += np.take(self.bias, own // GROUP, axis=0)
        return z

    def gradient(self, tokens: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Of the mean negative log-probability, laid out like ``flat``."""
        n = len(place)
        h, own = self.hidden(tokens, place), tokens[place]

        def wanted(z: np.ndarray, right: np.ndarray) -> np.ndarray:
            e, total = self._softmax(z)
            e *= (1 / (n * total))[:, None]
            e[np.arange(len(e)), right] -= np.float32(1 / n)
            return e

        z = wanted(h @ self.top + self.top_bias, own // GROUP)
        dh, top, top_bias = z @ self.top.T, h.T @ z, z.sum(0)
        within, bias = np.zeros_like(self.within), np.zeros_like(self.bias)
        order, groups = self._grouped(own)
        sorted_h, sorted_own, inner = np.take(h, order, axis=0), own[order], np.empty_like(h)
        z = wanted(self._members(sorted_h, sorted_own, groups), sorted_own % GROUP)
        for g, part in groups:
            within[g], bias[g] = sorted_h[part].T @ z[part], z[part].sum(0)
            np.matmul(z[part], self.within[g].T, out=inner[part])
        back = np.empty_like(order)
        back[order] = np.arange(n)
        dh += np.take(inner, back, axis=0)
        dh *= 1 - h * h
        tables, row = np.zeros_like(self.inputs), np.empty_like(dh)
        for table, o in zip(tables, OFFSETS):
            met = tokens[place + o].astype(np.int16)
            order = np.argsort(met, kind="stable")
            seen = met[order]
            first = np.flatnonzero(np.r_[True, seen[1:] != seen[:-1]])
            np.take(dh, order, axis=0, out=row, mode="clip")
            table[seen[first]] = np.add.reduceat(row, first, axis=0)
        return np.concatenate([tables.ravel(), dh.sum(0), top.ravel(), top_bias, within.ravel(), bias.ravel()])


class Learner:
    """Adagrad steps on a copy of the shared weights, over the documents of one task."""

    def __init__(self, weights: np.ndarray, phase: int):
        self.net, self.phase, self.tokens, self.held, self.waiting = Net(weights), phase, 0, [], 0
        self.square = np.full(len(self.net.flat), 1e-6, dtype=np.float32)

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= STEP * EVERY:
            self.learn()

    def learn(self) -> None:
        if not self.waiting:
            return
        tokens, place, _ = padded(self.held)
        # counted from the start of the document, so that passes agree however rows are dealt to tasks
        within = np.concatenate([np.arange(len(ids)) for ids in self.held])
        place = place[within % EVERY == self.phase % EVERY]
        for at in range(0, len(place), STEP):
            part = place[at:at + STEP]
            g = self.net.gradient(tokens, part)
            self.square += g * g
            self.net.flat -= RATE * g / np.sqrt(self.square)
            self.tokens += len(part)
        self.held, self.waiting = [], 0


#: Factors by a byte's place in its word, modulo 4096 and divided by 4096; a short word's hash needs the first alone.
_FACTOR = np.random.default_rng(8).integers(0, 1 << 64, (2, 4096), dtype=np.uint64) | np.uint64(1)
_FACTOR[1, 0] = 1


def _hashes(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hash of each whole word."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    first = np.cumsum(size) - size
    within = np.arange(size.sum()) - np.repeat(first, size)
    value = (raw[np.repeat(start, size) + within].astype(np.uint64) + np.uint64(1)) * _FACTOR[0][within & 4095]
    if size.max() > 4096:
        value *= _FACTOR[1][(within >> 12) & 4095]
    key = np.add.reduceat(value, first)
    return (key ^ (key >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)


def _pairs(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pairs of bytes from the space before each word to the one after it, first pair of each word)."""
    size1 = size + 1
    first = np.cumsum(size1) - size1
    at = np.repeat(start, size1) + np.arange(size1.sum()) - np.repeat(first, size1)
    clean = np.where(_IS_SPACE[raw], 32, raw).astype(np.int64)
    return clean[at - 1] * 256 + clean[at], first


def _between_spaces(data: bytes) -> np.ndarray:
    return np.frombuffer(b" " + data + b" ", dtype=np.uint8)


class Shares:
    """log p(word | its hash class), the part of a word's probability that the network does not give.

    A word counted ``LEAST`` times has its share of the class's occurrences, less ``DISCOUNT``; so the
    table grows with the corpus.  What rarer words and the discounts leave over goes to all other words by
    their spelling: the chain of their bytes as learnt from the rarer words, over the class's part of those.
    """

    def __init__(self, key: np.ndarray, cls: np.ndarray, n: np.ndarray, rare: np.ndarray, kinds: np.ndarray, pairs: np.ndarray):
        """Hash, class and count of the words with a share; occurrences and number of rarer words by class; counts of their pairs of bytes."""
        order = np.argsort(key)
        self.key = key[order]
        whole = np.bincount(cls, n, CLASSES) + rare + 1
        self.share = (np.log(n - DISCOUNT) - np.log(whole[cls]))[order].astype(np.float32)
        self.rest = (np.log((rare + DISCOUNT * np.bincount(cls, minlength=CLASSES) + 1) / whole)).astype(np.float64)
        self.part = np.log((kinds + 1) / (kinds.sum() + CLASSES))
        chain = pairs.reshape(256, 256) + 0.5
        self.chain = np.log(chain / chain.sum(1, keepdims=True)).ravel()

    def of(self, data: bytes, ids: np.ndarray) -> np.ndarray:
        """Of each word of ``data`` (lower case), whose numbers are ``ids``; a frequent word is alone in its class."""
        out, done = np.zeros(len(ids)), 0
        for part in _cuts(data):
            raw = _between_spaces(part)
            start, size = _spans(raw)
            at = np.flatnonzero(ids[done:done + len(start)] >= WORDS)
            if len(at):
                key = _hashes(raw, start[at], size[at])
                order = np.argsort(key)  # neighbours in the table are met together
                at, key = at[order], key[order]
                met = np.zeros(len(at), dtype=bool)
                value = np.zeros(len(at))
                if len(self.key):
                    place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
                    met = self.key[place] == key
                    value[met] = self.share[place[met]]
                rare = at[~met]
                if len(rare):
                    cls = ids[done + rare] - WORDS
                    pair, first = _pairs(raw, start[rare], size[rare])
                    value[~met] = self.rest[cls] + np.minimum(np.add.reduceat(self.chain[pair], first) - self.part[cls], 0)
                out[done + at] = value
            done += len(start)
        return out


def least_count(counts: DataFrame) -> int:
    """The count from which words have a share of their own: ``LEAST``, or the least that leaves at most ``SHARED_WORDS`` of them."""
    size = F.least(F.col("n"), F.lit(1 << 16))  # one row for each count at most
    kinds = sorted(((r["n"], r["kinds"]) for r in counts.where(F.col("n") >= LEAST).groupBy(size.alias("n")).agg(F.count(F.lit(1)).alias("kinds")).collect()),
                   reverse=True)
    held = 0
    for n, k in kinds:
        held += k
        if held > SHARED_WORDS:
            return n + 1
    return LEAST


def word_shares(counts: DataFrame, tokens: Tokens) -> Shares:
    """The shares of all words in ``counts`` (word, n).  Only words with a share of their own reach the driver as rows, a bounded number."""
    least = least_count(counts)

    def run(batches):
        for batch in slices(batches):
            data = b" ".join(batch.column(0).to_pylist())
            n = batch.column(1).to_numpy(zero_copy_only=False)
            ids = np.concatenate([tokens._slice(part) for part in _cuts(data)] or [np.zeros(0, dtype=np.int32)])
            cuts = [(raw, *_spans(raw)) for raw in map(_between_spaces, _cuts(data))]
            key = np.concatenate([_hashes(*c) for c in cuts] or [np.zeros(0, dtype=np.uint64)])
            cls = ids - WORDS
            own, rare = (cls >= 0) & (n >= least), (cls >= 0) & (n < least)
            pairs, before = np.zeros(1 << 16, dtype=np.int64), 0
            for raw, start, size in cuts:
                mine = rare[before:before + len(start)]
                if mine.any():
                    pairs += np.bincount(_pairs(raw, start[mine], size[mine])[0], minlength=1 << 16)
                before += len(start)
            seen = np.flatnonzero(pairs)
            k = np.arange(CLASSES)
            columns = [("own", key[own].view(np.int64), cls[own], n[own]), ("rare", k, k, np.bincount(cls[rare], n[rare], CLASSES).astype(np.int64)),
                       ("kinds", k, k, np.bincount(cls[rare], minlength=CLASSES)), ("pairs", seen, seen * 0, pairs[seen])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([c[0] for c in columns], [len(c[1]) for c in columns]), type=pa.string()),
                 *(pa.array(np.concatenate([c[i] for c in columns]).astype(np.int64)) for i in (1, 2, 3))], names=["what", "key", "cls", "n"])

    made = counts.mapInArrow(run, "what string, key long, cls long, n long")
    own = made.where("what = 'own'").select("key", "cls", "n").toArrow()
    key, cls, n = (own.column(i).to_numpy() for i in range(3))
    sums = {"rare": np.zeros(CLASSES), "kinds": np.zeros(CLASSES), "pairs": np.zeros(1 << 16)}
    for r in made.where("what <> 'own'").groupBy("what", "key").agg(F.sum("n").alias("n")).collect():
        sums[r.what][r.key] = r.n
    return Shares(key.view(np.uint64), cls, n.astype(np.float64), **sums)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of all documents."""
    d = docs.select(F.col(text))

    def run(batches):
        counts: Counter = Counter()

        def made():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), type=pa.binary()), pa.array(list(counts.values()), type=pa.int64())], names=["word", "n"])

        for batch in slices(batches):
            for t in batch.column(0):
                for words in word_slices((t.as_py() or "").encode().lower()):
                    counts.update(words)
                if len(counts) > COUNTED:
                    yield made()
                    counts.clear()
        yield made()

    return d.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def token_counts(counts: DataFrame, tokens: Tokens) -> np.ndarray:
    """Occurrences of each number, from the counts of words."""

    def run(batches):
        total = np.zeros(SIZE)
        for batch in slices(batches):
            if batch.num_rows:
                ids = np.concatenate([tokens._slice(part) for part in _cuts(b" ".join(batch.column(0).to_pylist()))])
                total += np.bincount(ids, batch.column(1).to_numpy(zero_copy_only=False), SIZE)
        return {"n": total}

    return array_sums(counts.select("word", "n"), run).get("n", np.zeros(SIZE))


def frequent_words(counts: DataFrame) -> list[bytes]:
    """The ``WORDS`` most frequent words of ``counts``; ties by the word."""
    return [bytes(r.word) for r in counts.orderBy(F.desc("n"), "word").limit(WORDS).collect()]


def train_words(docs: DataFrame, text: str = "text", seed: int = 0) -> tuple[Tokens, Net, Shares]:
    """The network and the shares of words in their classes, from one count of all words."""
    counts = cut_lineage(word_counts(docs, text))
    tokens, net = train(docs, text, seed, counts)
    return tokens, net, word_shares(counts, tokens)


def train(docs: DataFrame, text: str = "text", seed: int = 0, counts: DataFrame | None = None) -> tuple[Tokens, Net]:
    """The network over frequent words and hash classes, trained on all documents.

    In each pass every block of about ``BLOCK`` tokens starts from the same weights and learns from its documents; weights are
    averaged, weighed by the number of predicted tokens.  A tree of tasks adds them up chunk by chunk, so no task
    or driver holds more than a few networks.  A pass without tokens leaves the weights as they are.
    """
    counts = cut_lineage(word_counts(docs, text)) if counts is None else counts
    tokens = Tokens(frequent_words(counts))
    net = Net(seed=seed)
    net.start_from(token_counts(counts, tokens))
    total = counts.agg(F.sum("n")).first()[0] or 0
    d = docs.select(F.col(text)).coalesce(max(1, total // BLOCK))
    for phase in range(PASSES):
        weights = net.flat

        def run(batches, weights=weights, phase=phase):
            total, n, learner = np.zeros(len(weights)), 0, Learner(weights, phase)

            def done():
                nonlocal n
                learner.learn()
                n += learner.tokens
                total[:] += learner.net.flat.astype(np.float64) * learner.tokens

            for batch in slices(batches):
                for ids in tokens.of_all(t.as_py() for t in batch.column(0)):
                    learner.add(ids)
                    if learner.tokens * EVERY >= BLOCK:
                        done()
                        learner = Learner(weights, phase)
            done()
            return {"w": total, "n": np.array([float(n)])} if n else {}

        sums = array_sums(d, run)
        if sums:
            net = Net(sums["w"] / sums["n"])
    return tokens, net


def pseudo_likelihood(docs: DataFrame, tokens: Tokens, net: Net, text: str = "text", id_col: str = "doc_id",
                      shares: Shares | None = None) -> DataFrame:
    """(id, n_tokens, log_likelihood, mean_log_prob, perplexity) of every row.

    With ``shares`` the likelihood is that of the words, without them that of their classes.  The sum runs over all tokens of the whole text, each predicted from both sides with itself masked.
    A text without words has 0 tokens, log-likelihood 0 and null means.  Repeated rows and null ids
    stay; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    # one copy a worker, as the table of words may be large
    sent = docs.sparkSession.sparkContext.broadcast(shares)

    def make():
        shares = sent.value

        def one(batch: pa.RecordBatch):
            n, total, held, texts, waiting = [], [], [], [], 0

            def flush():
                row, place, doc = padded(held)
                sums = np.zeros(len(held))
                for at in range(0, len(place), SLICE):
                    s = slice(at, at + SLICE)
                    sums += np.bincount(doc[s], weights=net.log_probs(row, place[s]), minlength=len(held))
                if shares is not None:
                    own = shares.of(b" ".join((t or "").encode().lower() for t in texts), np.concatenate(held))
                    sums += np.bincount(doc, weights=own, minlength=len(held))
                total.extend(sums.tolist())

            for t, ids in zip(batch.column(1), tokens.of_all(t.as_py() for t in batch.column(1))):
                texts.append(t.as_py())
                held.append(ids)
                n.append(len(ids))
                waiting += n[-1]
                if waiting >= 64 * SLICE:
                    flush()
                    held, texts, waiting = [], [], 0
            if held:
                flush()
            mean = [s / k if k else None for s, k in zip(total, n)]
            return {id_col: batch.column(0), "n_tokens": n, "log_likelihood": total, "mean_log_prob": mean,
                    "perplexity": [None if m is None else float(np.exp(-m)) for m in mean]}
        return one

    return map_batches(docs.select(F.col(id_col), F.col(text)),
                       f"`{id_col}` {kind}, n_tokens long, log_likelihood double, mean_log_prob double, perplexity double", make)
