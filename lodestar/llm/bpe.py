"""Byte-level BPE: overlapping chunk encoding, and decoding by joining raw bytes."""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.llm.common import map_batches

#: Characters by which chunks advance, and by which neighbours overlap.
STRIDE = 32 * 1024
OVERLAP = 512

_loaded: dict[tuple[str, str], object] = {}


def encoding(path: str, pattern: str):
    """The library's encoder for a rank file, built once in a worker."""
    if (path, pattern) not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _loaded[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path, pattern]


def encode(enc, text: str) -> bytes:
    """Ids of a text as little-endian 32-bit integers; special strings are ordinary text."""
    return enc.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes() if text else b""


def decode(enc, ids: bytes, step: int = 1 << 18):
    """The raw bytes of ids, a slice at a time."""
    import numpy as np

    all_ids = np.frombuffer(ids, dtype="<u4")
    for at in range(0, len(all_ids), step):
        yield enc.decode_bytes(all_ids[at:at + step].tolist())


def digest(enc, ids: bytes) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids and SHA-256 of the decoded bytes."""
    raw = hashlib.sha256()
    for part in decode(enc, ids):
        raw.update(part)
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), raw.hexdigest()


def boundaries(pattern, text: str) -> list[int]:
    """Ends of pre-tokens that cannot change when the text goes on; the last one may, so it is left out."""
    ends = [m.end() for m in pattern.finditer(text)]
    return ends[:-1]


def _kind(c: str) -> str:
    return "s" if c.isspace() else "l" if c.isalpha() else "n" if c.isnumeric() else "o"


def can_part(before: str, after: str) -> bool:
    """Whether a cut between these characters leaves the look-aheads on both sides alone.

    White space before a cut would lose the sight of what follows it, and an apostrophe or a mark
    before a letter may belong to a contraction.
    """
    b, a = _kind(before), _kind(after)
    return after in " \n" and b != "s" or b in "ln" and a not in (b, "s")


def stitch(left: list[int], right: list[int], parts: list[int]) -> int | None:
    """First boundary that two overlapping chunks agree on and where the text can be parted."""
    both = sorted(set(left) & set(right) & set(parts))
    return both[0] if both else None


def chunks(texts: DataFrame, stride: int, overlap: int) -> DataFrame:
    """(key, k, n, body): chunk k holds the characters from k * stride, ``overlap`` more than a stride.

    ``key`` stands for a distinct text; copies of a text are encoded once.
    """
    n = F.ceil(F.length("text") / F.lit(stride)).cast("int")
    cut = (texts.withColumn("n", n)
           .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
           .select("key", "k", "n", F.expr(f"substring(text, k * {stride} + 1, {stride + overlap})").alias("body")))
    return cut.groupBy("key", "k").agg(F.first("n").alias("n"), F.first("body").alias("body"))


def encode_long(texts: DataFrame, path: str, pattern: str, stride: int = STRIDE, overlap: int = OVERLAP) -> DataFrame:
    """(key, ids) of distinct long texts (key, text), encoded by chunks in parallel.

    Every chunk is pre-tokenised on its own and reports its boundaries inside the zones it shares
    with its neighbours.  In each zone the neighbours are stitched at the first boundary on which
    both agree and where the text can be parted; the pieces between stitches are then encoded apart
    and their ids joined in order.  A zone without such a place is bridged: its two chunks become
    one piece, so any text, also one without white space, is encoded exactly.
    """
    def make_zones():
        import regex

        pat = regex.compile(pattern)

        def one(batch: pa.RecordBatch):
            key, k, n, body = (batch.column(i) for i in range(4))
            head, tail, parts = [], [], []
            for ki, b in zip(k.to_pylist(), body.to_pylist()):
                ends = boundaries(pat, b)
                head.append([e for e in ends if e < overlap])
                tail.append([e - stride for e in ends if e >= stride])
                parts.append([i for i in range(1, min(overlap, len(b))) if can_part(b[i - 1], b[i])])
            return {"key": key, "k": k, "n": n, "body": body, "head": head, "tail": tail, "parts": parts}
        return one

    zones = map_batches(chunks(texts, stride, overlap),
                        "key string, k int, n int, body string, head array<int>, tail array<int>, parts array<int>",
                        make_zones)
    w = Window.partitionBy("key").orderBy("k")
    agreed = F.array_intersect(F.array_intersect(F.lag("tail").over(w), F.col("head")), F.col("parts"))
    cuts = (zones.withColumn("start", F.when(F.col("k") == 0, F.lit(0)).otherwise(F.array_min(agreed)))
            .withColumn("next", F.lead("start").over(w))
            .withColumn("piece", F.count("start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .select("key", "k", "piece", F.expr(
                "substring(body, coalesce(start, 0) + 1, CASE WHEN next IS NOT NULL THEN next + {0}"
                " WHEN k = n - 1 THEN length(body) ELSE {0} END - coalesce(start, 0))".format(stride)).alias("part")))
    whole = (cuts.groupBy("key", "piece").agg(F.sort_array(F.collect_list(F.struct("k", "part"))).alias("parts"))
             .select("key", "piece", F.array_join(F.col("parts.part"), "").alias("text")))

    def make_ids():
        enc = encoding(path, pattern)

        def one(batch: pa.RecordBatch):
            return {"key": batch.column(0), "piece": batch.column(1),
                    "ids": [encode(enc, t) for t in batch.column(2).to_pylist()]}
        return one

    ids = map_batches(whole, "key string, piece long, ids binary", make_ids)
    joined = ids.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("p")).select("key", F.col("p.ids").alias("p"))

    def make_joined():
        return lambda batch: {"key": batch.column(0), "ids": [b"".join(p) for p in batch.column(1).to_pylist()]}

    return map_batches(joined, "key string, ids binary", make_joined)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", stride: int = STRIDE,
                     overlap: int = OVERLAP) -> DataFrame:
    """All columns of ``docs`` but the text, with ``ids`` (binary, little-endian 32-bit), in any order.

    Texts up to ``stride`` characters are one chunk and are encoded where they are read, without a
    shuffle; longer ones go through ``encode_long``.  Null text is empty and gives no ids.  Repeated
    rows and null ids stay.  Input columns named ``ids`` are replaced.
    """
    rest = [c for c in docs.columns if c not in (text, "ids")]
    d = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias("ids"))
    long = F.length("ids") > stride
    short = d.where(~F.coalesce(long, F.lit(False)))
    schema = d.select(*[F.col(f"`{c}`") for c in rest], F.lit(None).cast("binary").alias("ids")).schema

    def make():
        enc = encoding(path, pattern)

        def one(batch: pa.RecordBatch):
            made = {c: batch.column(i) for i, c in enumerate(rest)}
            made["ids"] = [encode(enc, t) for t in (v.as_py() for v in batch.column(len(rest)))]
            return made
        return one

    # the other columns travel as one struct, so they may have any names
    far = d.where(long).select(F.struct(F.lit(0).alias("ids"), *[F.col(f"`{c}`") for c in rest]).alias("row"), F.sha2("ids", 256).alias("key"), F.col("ids").alias("text"))
    coded = encode_long(far.select("key", "text"), path, pattern, stride, overlap)
    far = far.select("row", "key").join(coded, "key").select(*[F.col(f"row.`{c}`") for c in rest], "ids")
    return map_batches(short, schema, make).unionByName(far)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", id_col: str = "doc_id",
            stride: int = STRIDE, overlap: int = OVERLAP) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: whole texts encoded, then decoded again."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    long = F.coalesce(F.length("text") > stride, F.lit(False))

    def maker(coded: bool):
        """Digests of texts, or of ids that are already there; short texts are encoded and decoded by one worker."""
        def make():
            enc = encoding(path, pattern)

            def one(batch: pa.RecordBatch):
                rows = [digest(enc, v.as_py() if coded else encode(enc, v.as_py())) for v in batch.column(1)]
                return {id_col: batch.column(0), "n_tokens": [r[0] for r in rows],
                        "ids_sha256": [r[1] for r in rows], "decoded_sha256": [r[2] for r in rows]}
            return one
        return make

    far = encode_documents(d.where(long), path, pattern, "text", stride, overlap).select("id", "ids")
    return map_batches(d.where(~long), schema, maker(False)).unionByName(map_batches(far, schema, maker(True)))
