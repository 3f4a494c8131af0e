"""Importance resampling of documents towards a target text (op 11).

Runs of words are hashed into a fixed number of buckets.  A bucket's gain says how much commoner it is in
the target than in the source; a document's weight is the mean gain of its runs, read from one array.
Weight plus seeded Gumbel noise is the score, and the highest scores are drawn.

The cutoff is found by weighted median-of-medians selection: every task names the median of the keys it still
holds, the median of these medians, weighted by how many keys stand behind each, is the pivot, and at
least a quarter of the keys is discarded in each round until the pivot is the cutoff itself.  Only the
winners are sorted.

Defined results: a null text has no words; a document without words has no features, weight 0; a null
doc_id hashes as the empty text and comes last among ties; rows that are equal in every column share a
key, and as many copies are drawn as fit; an empty target or source has counts of zero; other columns are
never read by name, so theirs may clash.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import in_runs, map_batches, row_key
from lodestar.operators.prefix import running_totals
from lodestar.session import scratch

BUCKETS = 10_000
SEED = 7
#: Fewest words of a document that may be drawn, and how many of these are drawn, in percent.
LEAST_WORDS, PERCENT = 20, 25
#: Bytes of text that are worked on at a time.
SLICE = 1 << 21
#: Longer words are hashed one by one.
LONG_WORD = 48

#: Lower-cased byte of a word, or 0 for a byte between words.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], dtype=np.uint8)
_gap = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def _crc_table() -> np.ndarray:
    """CRC-32 of every byte: eight halvings with the reversed polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()
_START = np.uint32(0xFFFFFFFF)


def _advance(state: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes ``data[begin : begin + size]`` of each word, all words a byte at a time."""
    out = state.copy()
    short = np.flatnonzero(size <= LONG_WORD)
    order = short[np.argsort(size[short].astype(np.uint8), kind="stable")[::-1]]  # longest first
    left = len(order) - np.cumsum(np.bincount(size[order], minlength=LONG_WORD + 1))
    reg, at = out[order], begin[order]
    for i in range(LONG_WORD):
        n = left[i]  # words with more than i bytes
        if not n:
            break
        reg[:n] = _CRC[(reg[:n] ^ data[at[:n] + i]) & 0xFF] ^ (reg[:n] >> 8)
    out[order] = reg
    for w in np.flatnonzero(size > LONG_WORD):
        out[w] = zlib.crc32(data[begin[w]:begin[w] + size[w]], int(out[w]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return out


def _scan(raw: np.ndarray, bounds: np.ndarray, buckets: int, carry: np.uint32 | None = None):
    """(row of each word, bucket of each word, row of each pair, bucket of each pair, register of the last word).

    ``bounds`` are the offsets of the rows in ``raw``; ``carry`` is the register of a word that goes before the first.
    """
    data = _FOLD[raw]
    inside = data != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(raw))]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    begin, size = np.flatnonzero(first), np.flatnonzero(last) + 1
    size -= begin
    row = np.searchsorted(bounds, begin, side="right") - 1
    word = _advance(np.full(len(begin), _START), data, begin, size)
    before = np.concatenate([[_START if carry is None else carry], word[:-1]]).astype(np.uint32) if len(word) else word
    joined = np.flatnonzero(np.concatenate([[carry is not None], row[1:] == row[:-1]])) if len(word) else np.zeros(0, dtype=np.int64)
    gap = _CRC[(before[joined] ^ np.uint32(32)) & 0xFF] ^ (before[joined] >> 8)
    pair = _advance(gap, data, begin[joined], size[joined])
    bucket = lambda reg: ((reg ^ _START) % np.uint32(buckets)).astype(np.int64)
    return row, bucket(word), row[joined], bucket(pair), word[-1] if len(word) else carry


def scans(texts: pa.Array, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The words and pairs of a column of texts, about ``SLICE`` bytes at a time.

    Yields (first row, number of rows, row and bucket of each word, row and bucket of each pair); rows
    count from the first.  A text over ``SLICE`` bytes comes in several parts, cut between words.
    """
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1)
        low, high = int(offsets[at]), int(offsets[end])
        if high - low <= SLICE:
            yield at, end - at, *_scan(data[low:high], offsets[at:end] - low, buckets)[:4]
        else:
            carry = None
            while low < high:
                cut = _gap.search(memoryview(held), low + SLICE, high) if low + SLICE < high else None
                stop = cut.start() if cut else high
                *found, carry = _scan(data[low:stop], np.zeros(1, dtype=np.int64), buckets, carry)
                yield at, 1, *found
                low = stop
        at = end


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket is met in all texts: tasks count in an array and give it away once, Spark adds them up."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, _, words, _, pairs in scans(batch.column(0), buckets):
                total += np.bincount(words, minlength=buckets) + np.bincount(pairs, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["bucket", "n"])

    found = df.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in found.collect():  # one row for each bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's smoothed share in the target over that in the source, floored."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """1000 times a Gumbel number from a hash of the id, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(k1, k2, doc_id, n_words, n_features, weight, score) of every row; k1 and k2 are a hash of the whole row."""

    def make():
        def one(batch):
            n = batch.num_rows
            words, features, total = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for at, rows, word_row, word, pair_row, pair in scans(batch.column(3), len(gain)):
                own = slice(at, at + rows)
                w = np.bincount(word_row, minlength=rows)
                words[own] += w
                features[own] += w + np.bincount(pair_row, minlength=rows)
                for row, bucket in ((word_row, word), (pair_row, pair)):
                    total[own] += np.bincount(row, gain[bucket], minlength=rows).astype(np.int64)  # whole numbers below 2^53
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            score = weight + np.array([noise(i, seed) for i in batch.column(2).to_pylist()], dtype=np.int64)
            return {"k1": batch.column(0), "k2": batch.column(1), "doc_id": batch.column(2), "n_words": words,
                    "n_features": features, "weight": weight, "score": score}

        return one

    k1, k2 = row_key(docs)
    narrow = docs.select(k1.alias("k1"), k2.alias("k2"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(narrow, "k1 long, k2 long, doc_id long, n_words long, n_features long, weight long, score long", make)


# ---- selection ----

#: The order of the draw: each key is five whole numbers, the least comes first.
ORDER = ["down", "nil", "id", "k1", "k2"]


def _key_columns() -> list[Column]:
    return [(-F.col("score")).alias("down"), F.col("doc_id").isNull().cast("long").alias("nil"), F.coalesce("doc_id", F.lit(0)).alias("id"),
            F.col("k1"), F.col("k2")]


def _compare(keys: np.ndarray, to) -> tuple[np.ndarray, np.ndarray]:
    """Which columns of ``keys`` (5 × n) come before a key, and which equal it."""
    less, same = np.zeros(keys.shape[1], dtype=bool), np.ones(keys.shape[1], dtype=bool)
    for part, value in zip(keys, to):
        less |= same & (part < value)
        same &= part == value
    return less, same


def _kth(keys: np.ndarray, k: int) -> list[int]:
    """The key with ``k`` keys before it, found number by number in linear time."""
    out = []
    for i in range(len(keys)):
        value = np.partition(keys[i], k)[k]
        k -= int((keys[i] < value).sum())
        keys = keys[:, keys[i] == value]
        out.append(int(value))
    return out


def _round(keys: DataFrame, low: list[int] | None, high: list[int] | None, pivot: list[int] | None):
    """One scan over the keys strictly between ``low`` and ``high``.

    Every task gives back, for the keys before and the keys after the pivot, their number and their median, and the
    number equal to it; one row for each task comes to the driver.  Without a pivot all keys count as after it.
    """
    if low is not None:
        keys = keys.where(F.col("down") >= low[0])
    if high is not None:
        keys = keys.where(F.col("down") <= high[0])

    def run(batches):
        left = []
        for batch in batches:
            k = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            keep = np.ones(k.shape[1], dtype=bool)
            if low is not None:
                less, same = _compare(k, low)
                keep &= ~less & ~same
            if high is not None:
                keep &= _compare(k, high)[0]
            left.append(k[:, keep])
        held = np.concatenate(left, axis=1) if left else np.zeros((len(ORDER), 0), dtype=np.int64)
        less, same = _compare(held, pivot) if pivot is not None else (np.zeros(held.shape[1], dtype=bool), np.zeros(held.shape[1], dtype=bool))
        sides = [held[:, less], held[:, ~less & ~same]]
        if held.shape[1]:
            cells = [pa.array([[s.shape[1], *(_kth(s, s.shape[1] // 2) if s.shape[1] else [])]], pa.list_(pa.int64())) for s in sides]
            yield pa.RecordBatch.from_arrays([*cells, pa.array([int(same.sum())])], names=["before", "after", "same"])

    return keys.select(*ORDER).mapInArrow(run, "before array<long>, after array<long>, same long").collect()


def _weighted_median(sides: list[list[int]]) -> list[int] | None:
    """The median of the tasks' medians, each as heavy as the number of keys behind it."""
    ranked = sorted((s[1:], s[0]) for s in sides if s[0])
    half = sum(n for _, n in ranked) / 2
    for key, n in ranked:
        half -= n
        if half <= 0:
            return key
    return None


def cutoff(keys: DataFrame, k: int) -> tuple[list[int], int, int]:
    """(the k-th least key, how many keys are less, how many equal it), exactly; ``keys`` has the columns ``ORDER``.

    ``keys`` should be a written table: every round scans what it has left.
    """
    low = high = None
    skipped, pivot = 0, _weighted_median([r["after"] for r in _round(keys, None, None, None)])
    while pivot is not None:
        rows = _round(keys, low, high, pivot)
        before, same = sum(r["before"][0] for r in rows), sum(r["same"] for r in rows)
        if k <= skipped + before:
            high, side = pivot, "before"
        elif k <= skipped + before + same:
            return pivot, skipped + before, same
        else:
            low, side, skipped = pivot, "after", skipped + before + same
        pivot = _weighted_median([r[side] for r in rows])
    raise ValueError(f"fewer than {k} keys")


class Draw:
    """The scored rows of a table, written down once, and the key at which the draw ends."""

    def __init__(self, docs: DataFrame, target: DataFrame, seed: int = SEED, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
                 percent: int = PERCENT):
        spark = docs.sparkSession
        place = scratch(spark, "resample")
        score_documents(docs, gains(bucket_counts(docs, buckets=buckets), bucket_counts(target, buckets=buckets)), seed).write.parquet(place)
        self.least_words = least_words
        self.rows = spark.read.parquet(place)
        keys = self.rows.where(F.col("n_words") >= least_words).select(*_key_columns())
        self.n = percent * keys.count() // 100
        self.last, self.above, self.equal = cutoff(keys, self.n) if self.n else (None, 0, 0)

    def split(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Rows that are drawn for certain, rows at the cutoff, and rows that are not drawn."""
        if self.last is None:
            none = self.rows.where(F.lit(False))
            return none, none, self.rows
        rows = self.rows.select("*", *[c.alias(f"o_{n}") for c, n in zip(_key_columns(), ORDER)])
        less, same = F.lit(False), F.lit(True)
        for name, value in zip(ORDER, self.last):
            less, same = less | (same & (F.col(f"o_{name}") < value)), same & (F.col(f"o_{name}") == value)
        fit = F.col("n_words") >= self.least_words
        plain = self.rows.columns
        return rows.where(fit & less).select(*plain), rows.where(fit & same).select(*plain), rows.where(~fit | ~(less | same)).select(*plain)

    def copies_at_cutoff(self) -> int:
        """How many of the equal rows at the cutoff are drawn."""
        return self.n - self.above


def importance_ranks(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; ``rank`` is null where a row is not drawn.

    Equal rows are counted before they are ordered, so that a row that makes up a third of the table is one
    row of the sort.  ``settings`` are those of ``Draw``.
    """
    d = Draw(docs, target, **settings)
    above, at, rest = d.split()
    own = d.rows.columns
    counted = above.groupBy(*own).agg(F.count(F.lit(1)).alias("copies"))
    if d.last is not None:
        edge = at.limit(1)  # all of them are equal
        counted = counted.unionByName(edge.withColumn("copies", F.lit(d.copies_at_cutoff()).cast("long")))
        left = d.equal - d.copies_at_cutoff()
        if left:
            rest = rest.unionByName(in_runs(edge, F.lit(left), "place").drop("place"))
    counted = counted.withColumn("nil", F.col("doc_id").isNull())
    order = [("score", False), ("nil", True), ("doc_id", True), ("k1", True), ("k2", True)]
    placed = running_totals(counted, order, {"start": F.col("copies")}, exclusive=True)
    drawn = in_runs(placed, F.col("copies"), "place").withColumn("rank", F.col("start") + F.col("place") + 1)
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return drawn.select(*out).unionByName(rest.withColumn("rank", F.lit(None).cast("long")).select(*out))


def resample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn, whole and with their own columns only.

    A row's copies are drawn together, but for those at the cutoff, of which as many are kept as fit.
    """
    d = Draw(docs, target, **settings)
    above, at, _ = d.split()
    k1, k2 = row_key(docs)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), k1.alias("k1"), k2.alias("k2"))
    kept = keyed.join(above.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    if d.last is not None:
        edge = keyed.where((F.col("k1") == d.last[3]) & (F.col("k2") == d.last[4])).limit(1)
        kept = kept.unionByName(in_runs(edge, F.lit(d.copies_at_cutoff()), "place").drop("place"))
    return kept.select("row.*")

