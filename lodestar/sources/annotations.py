"""One annotation file of any size read by many tasks (S3).

A JSON object with lists of objects has no line ends to cut it at, and a bracket may stand inside a string.  Spark's
text reader splits it at closing braces, wherever they stand, so any file system that Spark reads will do.  Three scans
follow.  The first tells, for every split, how its quotes and brackets move a reader that starts outside a string
and one that starts inside; joined in order on the driver (one row for each split), they give the true state at each
start.  The second finds the list that each split ends in.  The third gives out the objects; the parts of one that
straddles splits are joined by the split in which it starts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ESCAPED = re.compile(r"\\.", re.S)
_MARK = re.compile(r'["\\\[\]{}]')
_KEY = re.compile(r'"((?:[^"\\]|\\.)*)"\s*:\s*$', re.S)


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the text between closing braces, in order within each split of a file."""
    t = spark.read.option("lineSep", "}").text(path)
    return t.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """Splits one after the other: (file, block) and the fragments, each with its brace again."""
    rows = ((f, b, v) for batch in batches for f, b, v in zip(*(batch.column(i).to_pylist() for i in range(3))))
    held = next(rows, None)
    while held is not None:
        key = held[:2]

        def own() -> Iterator[str]:
            nonlocal held
            while held is not None and held[:2] == key:
                yield held[2] + "}"
                held = next(rows, None)

        values = own()
        yield key, values
        for _ in values:  # what the caller left
            pass


def _turns(batches):
    """First scan: quotes (odd or even) and the change of depth, for a start outside and inside a string."""
    for (file, block), values in _runs(batches):
        odd, depth = False, [0, 0]
        for value in values:
            parts = _ESCAPED.sub("", value).split('"')
            for start in (0, 1):
                outside = "".join(parts[(start + odd) % 2::2])
                depth[start] += outside.count("{") + outside.count("[") - outside.count("}") - outside.count("]")
            odd ^= len(parts) % 2 == 0
        yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "odd": odd, "outside": depth[0], "inside": depth[1]}])


class _Reader:
    """Walks through fragments; ``depth`` 1 is the root, 2 a list of the root, 3 and more an object of the list."""

    def __init__(self, quoted: bool, depth: int, section: str | None):
        self.quoted, self.depth, self.section = quoted, depth, section
        self.least, self.open, self.inside = depth, [], depth >= 3
        self.last = ""

    def feed(self, text: str) -> Iterator[tuple[str, str | None]]:
        """The objects that end in ``text``, as (text, list)."""
        start = 0 if self.inside else None
        skip = -1
        for mark in _MARK.finditer(text):
            at, char = mark.start(), mark.group()
            if at == skip:
                continue
            if char == "\\":
                skip = at + 1
            elif char == '"':
                self.quoted = not self.quoted
            elif self.quoted:
                continue
            elif char in "{[":
                if self.depth == 1 and char == "[":
                    found = _KEY.search(self.last + text[:at])
                    self.section = found.group(1) if found else None
                elif self.depth == 2 and char == "{":
                    self.inside, start = True, at
                self.depth += 1
            else:
                self.depth -= 1
                self.least = min(self.least, self.depth)
                if self.depth == 2 and self.inside:
                    self.open.append(text[start:at + 1])
                    yield "".join(self.open), self.section
                    self.open, self.inside, start = [], False, None
        if self.inside:
            self.open.append(text[start:])
        self.last = (self.last + text)[-1024:] if self.depth <= 1 else ""


def read_annotation_file(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, DataFrame]:
    """S3: the lists of one (or many) JSON objects as tables, ``schema`` naming them; a file is split among tasks.

    Lists that ``schema`` does not name, and values of the root that are no lists, are passed over.  Keys of the root are
    at most 1,000 characters before their list.
    """
    fragments = _fragments(spark, path)
    moves = fragments.mapInArrow(_turns, "file string, block long, odd boolean, outside long, inside long").collect()  # one row for each split
    starts: dict[tuple[str, int], tuple[bool, int]] = {}
    quoted, depth, file = False, 0, None
    for m in sorted(moves, key=lambda m: (m["file"], m["block"])):
        if m["file"] != file:
            quoted, depth, file = False, 0, m["file"]
        starts[m["file"], m["block"]] = (quoted, depth)
        depth += m["inside"] if quoted else m["outside"]
        quoted ^= m["odd"]

    def ends(batches):
        for key, values in _runs(batches):
            reader = _Reader(*starts[key], None)
            seen = False
            for value in values:
                for _ in reader.feed(value):
                    pass
                seen |= reader.section is not None
            yield pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1], "section": reader.section, "least": reader.least, "open": reader.inside}],
                                             schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("section", pa.string()), ("least", pa.int64()), ("open", pa.bool_())]))

    found = fragments.mapInArrow(ends, "file string, block long, section string, least long, open boolean").collect()  # one row for each split
    sections: dict[tuple[str, int], str | None] = {}
    owners: dict[tuple[str, int], int] = {}
    section, owner, file = None, None, None
    for m in sorted(found, key=lambda m: (m["file"], m["block"])):
        if m["file"] != file:
            section, owner, file = None, None, m["file"]
        key = (m["file"], m["block"])
        sections[key], owners[key] = section, owner if owner is not None else m["block"]
        section = m["section"] if m["section"] is not None else section
        owner = (owner if m["least"] >= 3 and owner is not None else m["block"]) if m["open"] else None

    def objects(batches):
        for key, values in _runs(batches):
            reader = _Reader(*starts[key], sections[key])
            carried = reader.inside
            out = []

            def give():
                made = pa.RecordBatch.from_pylist(out, schema=pa.schema([("file", pa.string()), ("owner", pa.int64()), ("part", pa.int64()), ("section", pa.string()), ("text", pa.string())]))
                out.clear()
                return made

            for value in values:
                for text, section in reader.feed(value):
                    out.append({"file": key[0], "owner": owners[key] if carried else None, "part": key[1], "section": section, "text": text})
                    carried = False
                    if len(out) >= 512:
                        yield give()
            if reader.open:
                own = owners[key] if carried else key[1]
                out.append({"file": key[0], "owner": own, "part": key[1], "section": reader.section, "text": "".join(reader.open)})
            if out:
                yield give()

    rows = fragments.mapInArrow(objects, "file string, owner long, part long, section string, text string")
    cut = rows.where("owner IS NOT NULL").groupBy("file", "owner").agg(
        F.first("section").alias("section"), F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda p: p["text"])).alias("text"))
    whole = rows.where("owner IS NULL").select("section", "text").unionByName(cut.select("section", "text"))
    return {f.name: whole.where(F.col("section") == f.name).select(F.from_json("text", f.dataType.elementType).alias("o")).select("o.*") for f in schema.fields}
