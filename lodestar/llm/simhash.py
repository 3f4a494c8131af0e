"""SimHash near-duplicates: Golay-code fuzzy hashing of fingerprint segments, join by key, and verification."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches, row_key, word_slices
from lodestar.llm.forest import Forest
from lodestar.operators.network import connected
from lodestar.session import cut_lineage

#: Bits of the segments of a fingerprint, from the lowest; the code's words have 23.
SEGMENTS = (23, 23, 18)
#: The largest distance that the keys are sure to find.
REACH = 4
#: Fingerprints of one key that are compared together; more are dealt out in pairs of such blocks.
BLOCK = 16_384


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of a whole text, as an unsigned number; no words give 0.

    Words are runs of non-space bytes with A-Z in lower case; each shingle of ``shingle`` words (all
    words, if fewer), repeats included, votes with the bits of its XXH64 (seed 42).
    """
    import xxhash

    xx = xxhash.xxh64_intdigest
    data = (text or "").encode().lower()
    votes, n, carry = np.zeros(64, dtype=np.int64), 0, []
    for words in word_slices(data):
        words = carry + words
        if len(words) >= shingle:
            line = b" ".join(words)
            size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            end = np.cumsum(size + 1) - 1
            start = (end - size)[:len(words) - shingle + 1].tolist()
            h = np.array([xx(line[a:b], 42) for a, b in zip(start, end[shingle - 1:].tolist())], dtype="<u8")
            for at in range(0, len(h), 4096):
                bits = np.unpackbits(h[at:at + 4096].view(np.uint8), bitorder="little").reshape(-1, 64)
                votes += bits.sum(0, dtype=np.int64)
            n += len(h)
        carry = words[max(0, len(words) - shingle + 1):]
    if not n:
        return xx(b" ".join(carry), 42) if carry else 0
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


class Golay:
    """The perfect binary (23, 12, 7) code: every 23-bit word lies within 3 bits of exactly one codeword."""

    GENERATOR = 0b110001110101

    def __init__(self):
        def parity(word: int) -> int:
            for bit in range(22, 10, -1):
                if word >> bit & 1:
                    word ^= self.GENERATOR << (bit - 11)
            return word

        self.parity = np.array([parity(i << 11) for i in range(4096)], dtype=np.int64)
        self.error = np.zeros(2048, dtype=np.int64)
        for weight in (1, 2, 3):
            for bits in combinations(range(23), weight):
                e = sum(1 << b for b in bits)
                self.error[self.parity[e >> 11] ^ (e & 2047)] = e

    def index(self, word: np.ndarray) -> np.ndarray:
        """The number of the nearest codeword."""
        return (word ^ self.error[self.parity[word >> 11] ^ (word & 2047)]) >> 11

    def near(self, word: np.ndarray, bits: int) -> np.ndarray:
        """Columns: the codeword of a word and of each word one bit away.

        Two words two bits apart have a word in between, whose codeword both list; of words one bit
        apart, each lists the other's own codeword.
        """
        return np.stack([self.index(word)] + [self.index(word ^ (1 << b)) for b in range(bits)], axis=1)


def segments(fp: np.ndarray) -> list[np.ndarray]:
    """The segments of unsigned fingerprints."""
    out, at = [], 0
    for bits in SEGMENTS:
        out.append(((fp >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64))
        at += bits
    return out


def keys(fp: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the fuzzy keys of unsigned fingerprints; any two within ``REACH`` bits share one.

    Four errors over three segments leave two segments with at most two errors together: either one
    of them is exact and the other has at most two, or both have one.  For the first case a key is an
    exact segment with a codeword that the other segment lists; for the second it is the own codeword
    of one with a listed codeword of the other, both ways round.
    """
    seg = segments(fp)
    near = [code.near(s, bits) for s, bits in zip(seg, SEGMENTS)]
    rows, found = [], []
    kind = 0
    for a in range(3):
        for b in range(3):
            if a != b:
                pair = min(a, b) * 3 + max(a, b)
                exact = (kind << 40) | (seg[a][:, None] << 12) | near[b]
                listed = near[a][:, :1], near[b]
                first, second = listed if a < b else listed[::-1]
                both = ((16 + pair) << 40) | (first << 12) | second
                for k in (exact, both):
                    k = np.sort(k, axis=1)
                    new = np.ones(k.shape, dtype=bool)
                    new[:, 1:] = k[:, 1:] != k[:, :-1]
                    r, c = np.nonzero(new)
                    rows.append(r)
                    found.append(k[r, c])
                kind += 1
    rows, found = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
    return rows[new], found[new]


def stars(fp: np.ndarray, reach: int = REACH):
    """(first, other) of each connected group of sorted unsigned fingerprints, linked by distances up to ``reach``.

    A group grows by the fingerprints within reach of its newest members, so every step is verified.
    """
    left = fp
    while len(left):
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), dtype=bool)
            for at in range(0, len(front), 64):
                near |= (np.bitwise_count(front[at:at + 64, None] ^ left) <= reach).any(0)
            front, left = left[near], left[~near]
            yield from ((int(root), int(x)) for x in front)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Runs:
    """Links inside runs of equal keys of rows that come sorted by key, batch after batch.

    Short runs are compared by shifting the column against itself; longer ones by ``stars``.  A run
    beyond ``block`` is not compared here: its rows are handed on with the number of their block.
    """

    def __init__(self, reach: int, block: int):
        self.reach, self.block = reach, block
        self.forest = Forest()
        self.key, self.fp = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        self.blocks = 0  # blocks of the run at the end that were handed on

    def links(self, pairs) -> list[tuple]:
        return [(_signed(a), _signed(b), None, None) for a, b in pairs if self.forest.add(a, b)]

    def _compare(self, key: np.ndarray, fp: np.ndarray) -> list[tuple]:
        out = []
        cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=int)
        size = np.diff(np.r_[cuts, len(key)])
        for i in np.flatnonzero(size > 48):
            out += self.links(stars(np.sort(fp[cuts[i]:cuts[i] + size[i]]), self.reach))
        short = np.repeat((size > 1) & (size <= 48), size)
        key, fp = key[short], fp[short]
        for step in range(1, int(size[size <= 48].max(initial=0))):
            same = key[step:] == key[:-step]
            if not same.any():
                break
            a, b = fp[:-step][same], fp[step:][same]
            hit = np.bitwise_count(a ^ b) <= self.reach
            out += self.links(zip(a[hit].tolist(), b[hit].tolist()))
        return out

    def _hand_on(self, key: int, fp: np.ndarray) -> list[tuple]:
        self.blocks += 1
        return [(x, None, key, self.blocks - 1) for x in fp.astype(np.int64).tolist()]

    def add(self, key: np.ndarray, fp: np.ndarray) -> list[tuple]:
        out = []
        key, fp = np.r_[self.key, key], np.r_[self.fp, fp]
        last = int(np.searchsorted(key, key[-1])) if len(key) else 0
        if self.blocks and last:  # the run that was handed on ends here
            end = int(np.searchsorted(key, key[0], side="right"))
            out += self._hand_on(int(key[0]), fp[:end])
            key, fp, last, self.blocks = key[end:], fp[end:], last - end, 0
        out += self._compare(key[:last], fp[:last])
        key, fp = key[last:], fp[last:]
        while len(key) > self.block:
            out += self._hand_on(int(key[0]), fp[:self.block])
            key, fp = key[self.block:], fp[self.block:]
        self.key, self.fp = key, fp
        return out

    def end(self) -> list[tuple]:
        if self.blocks:
            return self._hand_on(int(self.key[0]), self.fp) if len(self.fp) else []
        return self._compare(self.key, self.fp)


def links(fps: DataFrame, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """(a, b): links among distinct fingerprints (``fp``, long) that connect exactly those within ``reach`` bits.

    Fingerprints meet by their fuzzy keys; every link is verified.  Rows of a key stream through a
    task in sorted order and only a forest of links leaves it.  A key with more than ``block``
    fingerprints is dealt out again: its blocks meet in pairs, each pair in a group of its own.
    """
    if not 0 <= reach <= REACH:
        raise ValueError(f"the keys find distances up to {REACH}")

    def make_keys():
        code = Golay()

        def one(batch: pa.RecordBatch):
            fp = batch.column(0).to_numpy().astype(np.uint64)
            rows, found = keys(fp, code)
            return {"key": found, "fp": fp[rows].astype(np.int64)}
        return one

    # every row becomes some sixty: spread them first, as the planner would gather so few small rows in one task
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = map_batches(fps.select("fp").repartition(tasks), "key long, fp long", make_keys)

    def run(batches):
        runs = Runs(reach, block)

        def made(rows):
            cols = list(zip(*rows)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(list(c), type=pa.int64()) for c in cols], names=["a", "b", "key", "part"])

        for batch in batches:
            if batch.num_rows:
                yield made(runs.add(batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint64)))
        yield made(runs.end())

    met = cut_lineage(keyed.repartition("key").sortWithinPartitions("key", "fp")
                      .mapInArrow(run, "a long, b long, key long, part long"))
    large = met.where("key IS NOT NULL").select("key", "part", F.col("a").alias("fp"))
    n = large.groupBy("key").agg((F.max("part") + 1).alias("n"))
    dealt = (large.join(n, "key").withColumn("other", F.explode(F.expr("sequence(0L, n - 1)")))
             .where("n > 1").select("key", F.least("part", "other").alias("s"), F.greatest("part", "other").alias("t"), "fp"))

    def compare(group: pa.Table) -> pa.Table:
        pairs = list(stars(np.unique(group.column("fp").to_numpy().astype(np.uint64)), reach))
        return pa.table({"a": pa.array([_signed(a) for a, _ in pairs], pa.int64()), "b": pa.array([_signed(b) for _, b in pairs], pa.int64())})

    far = dealt.groupBy("key", "s", "t").applyInArrow(compare, "a long, b long")
    return met.where("key IS NULL").select("a", "b").union(far).distinct()


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``fp``: the fingerprint as a signed long."""
    rest = [c for c in docs.columns if c not in (text, "fp")]
    d = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias("fp"))
    schema = d.select(*[F.col(f"`{c}`") for c in rest], F.lit(0).cast("long").alias("fp")).schema

    def make():
        def one(batch: pa.RecordBatch):
            made = {c: batch.column(i) for i, c in enumerate(rest)}
            return made | {"fp": [_signed(fingerprint(t.as_py(), shingle)) for t in batch.column(len(rest))]}
        return one

    return map_batches(d, schema, make)


def groups(marked: DataFrame, reach: int = REACH) -> DataFrame:
    """(fp, root) of every distinct fingerprint of ``marked``; equal roots are connected."""
    fps = marked.select("fp").distinct()
    joined = connected(links(fps, reach)).withColumnRenamed("node", "fp")
    return fps.join(joined, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, reach: int = REACH, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest id of the documents reachable by links of at most ``reach``
    differing bits.  Null and empty texts have fingerprint 0 and link like any other.  Null ids are
    left out of the smallest id; a group with null ids only has a null one.  Repeated rows stay; an
    empty table gives no rows.
    """
    marked = cut_lineage(fingerprints(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("text")), shingle))
    least = marked.groupBy("fp").agg(F.min("_id").alias("_least"))
    found = least.join(groups(marked, reach), "fp")
    ids = found.groupBy("root").agg(F.min("_least").alias("component_id"))
    by_fp = found.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, reach: int = REACH, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row with the smallest id stays.

    Among rows with that id, or with null ids only, a hash of the whole row decides; of equal rows
    one stays.
    """
    k1, k2 = row_key(docs)
    # a row travels as one struct, so its columns may have any names
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), k1.alias("_k1"), k2.alias("_k2"))
    own = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text}`").alias("text"), k1.alias("_k1"), k2.alias("_k2"))
    marked = cut_lineage(fingerprints(own, shingle))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), "_k1", "_k2")).alias("first")
    best = marked.groupBy("fp").agg(first)
    won = best.join(groups(marked, reach), "fp").groupBy("root").agg(F.min("first").alias("first"))
    won = won.select(F.col("first._k1").alias("_k1"), F.col("first._k2").alias("_k2"))
    return keyed.join(won, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select("row.*")
