"""Token counts: batch encoding that returns lengths only."""

from __future__ import annotations

import os
import re

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import map_batches

#: Texts handed to the library in one call hold about this many bytes.
BATCH_BYTES = 256 * 1024
#: Distinct pieces whose lengths a task remembers before it starts again.
REMEMBERED = 400_000

# White space outside ASCII, or what one library or another takes for it; a place next to it is not safe.
_ODD = "".join(map(chr, [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
_SPACE = " \\t-\\r"
# A piece starts at ASCII white space that follows a word.  No token of a byte-level vocabulary crosses such a
# place and no look-ahead reaches over it, so pieces can be encoded apart.  Odd white space belongs to the
# piece of the word before it, together with the word after it.
_piece = re.compile(f"[{_SPACE}{_ODD}]*[^{_SPACE}{_ODD}]+(?:[{_ODD}][{_SPACE}{_ODD}]*[^{_SPACE}{_ODD}]+)*(?:[{_ODD}][{_SPACE}{_ODD}]*)?|[{_SPACE}{_ODD}]+")
_odd_space = re.compile(f"[{_ODD}]")
_plain = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")  # the same for texts without odd white space
#: Longer pieces, as of scripts without spaces, are cut between a letter and punctuation too; apostrophes may belong to both sides.
LONG_PIECE = 256
_inside = regex.compile(r"(?<=\p{L})(?=[\p{Po}\p{Ps}\p{Pe}])(?!['\u2019])")


def pieces_of(text: str | None) -> list[str]:
    """The parts of a text that can be encoded apart; none is longer than the text between two safe places."""
    if not text:
        return []
    found = (_piece if _odd_space.search(text) else _plain).findall(text)
    if max(map(len, found)) > LONG_PIECE:
        cut = []
        for p in found:
            at = 0
            for m in _inside.finditer(p) if len(p) > LONG_PIECE else ():
                cut.append(p[at:m.start()])
                at = m.start()
            cut.append(p[at:])
        return cut
    return found


_loaded: dict[str, object] = {}


def tokenizer(path: str):
    """The library's tokenizer of a file, loaded once in a worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.no_truncation()
        made.no_padding()
        _loaded[path] = made
    return _loaded[path]


def byte_batches(pieces: list[str], limit: int = BATCH_BYTES):
    """Runs of ``pieces`` that hold about ``limit`` bytes each."""
    run, held = [], 0
    for p in pieces:
        run.append(p)
        held += len(p.encode())
        if held >= limit:
            yield run
            run, held = [], 0
    if run:
        yield run


class Lengths:
    """Numbers of tokens of texts; remembers the lengths of pieces met before, up to a bound."""

    def __init__(self, path: str):
        self.lib = tokenizer(path)
        self.known: dict[str, int] = {}

    def of(self, texts: list[str | None]) -> list[int]:
        split = [pieces_of(t) for t in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        fresh = list({p for pieces in split for p in pieces if p not in known})
        for run in byte_batches(fresh):
            known.update(zip(run, map(len, self.lib.encode_batch_fast(run, add_special_tokens=False))))
        counts = [sum(map(known.__getitem__, pieces)) for pieces in split]
        for p in fresh:  # long pieces are not worth remembering
            if len(p) > 64:
                known.pop(p, None)
        return counts


def token_counts(docs: DataFrame, path: str, limit: int = 512, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    Lengths are those of the tokenizer library without added special tokens; special strings inside
    a text are handled as the library does by default.  Texts are cut into pieces at white space after a word, which is
    a safe place, and long ones between a letter and punctuation too, so a text is encoded whole only where
    it is one run of letters or symbols; distinct pieces are encoded once in calls of about ``BATCH_BYTES``.
    There is no shuffle.

    Null text counts as empty (0 bytes, 0 tokens).  Null ids and repeated rows stay, one result row
    for each input row.  Only the id and text columns are read, so other columns can have any name.
    An empty table gives no rows.
    """
    def make():
        lengths = Lengths(path)

        def one(batch: pa.RecordBatch):
            texts = batch.column(1)
            out = []
            for group in _row_groups(texts):
                out += lengths.of(group)
            return {id_col: batch.column(0), "n_bytes": pc.fill_null(pc.binary_length(texts), 0),
                    "n_tokens": out, "over_limit": [n > limit for n in out]}

        return one

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(F.col(id_col), F.col(text)),
                       f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean", make)


def _row_groups(texts, limit: int = 8 << 20):
    """Python strings of consecutive rows, about ``limit`` characters at a time."""
    run, held = [], 0
    for value in texts:
        s = value.as_py()
        run.append(s)
        held += len(s or "")
        if held >= limit:
            yield run
            run, held = [], 0
    if run:
        yield run
