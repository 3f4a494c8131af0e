"""Chat formatting with spans found by rendering alone (op 13).

A template is a black box from messages to one string.  Its output is asked for after every turn; where an
output continues the one before, the new part is the turn's span, and where it does not, the template
rewrites history and the turn is marked.  Two renderings of the turn with texts that differ in their only
character show where the text lies inside the span.

Every prefix is whole: it starts at the first turn, so what a template writes for a turn may depend on all turns
before it.  Conversations are cut into chunks of ``CHUNK`` turns, so one of any length is spread over many tasks; a chunk
starts with copies of all turns before it.  The work on a conversation grows with the square of its turns, as prefixes
do.  For a template that is known to look back no further than some number of turns, ``memory`` shortens the prefixes to that.

Defined results: null texts and roles are empty.  Turns are ordered by ``turn`` (nulls last), then role, then text; rows that
are equal are several turns.  A null conv_id is a conversation of its own.  An empty table has no
conversations.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lodestar.llm.common import map_batches
from lodestar.operators.prefix import grouped_row_number

#: Turns of a chunk.
CHUNK = 256

Messages = list[tuple[str, str]]


class Template:
    """Turns between control strings; control strings inside a text or a role are escaped with a backslash.

    ``[INST] text [/INST]`` for the user, ``[ANS] text</s>`` for the assistant, ``[SYS] text [/SYS]`` for the system
    and ``[TURN] role [SAYS] text [/TURN]`` for any other role; the whole starts with ``<s>``.
    """

    MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("[ANS] ", "</s>"), "system": ("[SYS] ", " [/SYS]")}
    START, OTHER, SAYS, END = "<s>", "[TURN] ", " [SAYS] ", " [/TURN]"
    CONTROL = [START, "</s>", "[INST]", "[/INST]", "[ANS]", "[SYS]", "[/SYS]", "[TURN]", "[SAYS]", "[/TURN]"]
    #: Characters of written turns that are held at a time.
    HELD = 1 << 24
    _escape = re.compile("|".join(map(re.escape, ["\\", *CONTROL])))
    _unescape = re.compile(r"\\(.)", re.S)

    def __init__(self):
        self._held: dict[tuple[str, str], str] = {}
        self._room = self.HELD

    def escape(self, text: str) -> str:
        """Backslashes doubled, and one put behind the first character of every control string."""
        return self._escape.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)

    def unescape(self, text: str) -> str:
        """Each backslash gives way to the character behind it."""
        return self._unescape.sub(r"\1", text)

    def __call__(self, messages: Iterable[tuple[str, str]]) -> str:
        return self.START + "".join([self._held.get((role, text)) or self._turn(role, text) for role, text in messages])

    def _turn(self, role: str, text: str) -> str:
        """One written turn, held for the next prefixes that have it."""
        head, tail = self.MARKS.get(role) or (f"{self.OTHER}{self.escape(role)}{self.SAYS}", self.END)
        out = f"{head}{self.escape(text)}{tail}"
        self._room -= len(out)
        if self._room < 0:
            self._held.clear()
            self._room = self.HELD - len(out)
        self._held[role, text] = out
        return out

    def read(self, formatted: str) -> Messages:
        """The messages of a formatted conversation or of its continuation, by its control strings alone."""
        at = len(self.START) if formatted.startswith(self.START) else 0
        out = []
        while at < len(formatted):
            for role, (head, tail) in [*self.MARKS.items(), (None, (self.OTHER, self.END))]:
                if formatted.startswith(head, at):
                    at += len(head)
                    end = formatted.index(tail, at)
                    body, at = formatted[at:end], end + len(tail)
                    if role is None:
                        role, _, body = body.partition(self.SAYS)
                        role = self.unescape(role)
                    out.append((role, self.unescape(body)))
                    break
            else:
                raise ValueError(f"no turn starts at {formatted[at:at + 20]!r}")
        return out


class Span:
    """What a template added for a turn: the piece, the text's place in it (from, to), and whether it kept all before."""

    __slots__ = ("piece", "start", "stop", "keeps")

    def __init__(self, piece: str, start: int, stop: int, keeps: bool):
        self.piece, self.start, self.stop, self.keeps = piece, start, stop, keeps


def _common(a: str, b: str) -> int:
    """Length of the longest common start, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def spans(render: Callable[[Messages], str], messages: Messages, context: int = 0, memory: int | None = None) -> list[Span]:
    """The span of every message after the first ``context`` ones, from renderings of successive prefixes.

    Prefixes are whole, or the ``memory`` turns before each message.  What a template writes before any turn belongs to the first.
    Where a rendering does not continue the one before, the span is what follows the part they share, and ``keeps`` is
    false.  Where the two probes do not show one place for the text, its span is empty at the end of the piece.
    """
    out, new = [], None
    for i in range(context, len(messages)):
        role, _ = messages[i]
        before = messages[:i] if memory is None else messages[max(0, i - memory):i]
        # the last rendering serves again where it is that of the same turns
        old = new if new is not None and (memory is None or i <= memory) else render(before) if before else ""
        new = render([*before, messages[i]])
        shared = len(old) if new.startswith(old) else _common(old, new)
        a, b = render([*before, (role, "0")]), render([*before, (role, "1")])
        place = _common(a, b)
        tail = len(a) - place - 1
        single = len(a) == len(b) and place >= shared and a[place:place + 1] == "0" and a[place + 1:] == b[place + 1:]
        fits = single and new[:place] == a[:place] and new.endswith(a[place + 1:]) and len(new) >= place + tail
        piece = new[shared:]
        start, stop = (place - shared, len(new) - tail - shared) if fits else (len(piece), len(piece))
        out.append(Span(piece, start, stop, new.startswith(old)))
    return out


#: Up to so many long conversations are told to every task; beyond, the join shuffles.
TOLD = 10_000


def _chunks(rows: DataFrame) -> DataFrame:
    """(conv_id, added, chunk, turns): the turns of every chunk in order, copies from before it first."""
    turn = F.struct(F.expr("NOT context").alias("own"), "nil", "turn", "role", "text")
    out = rows.groupBy("conv_id", "added", "chunk").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # the copies that reach beyond the last turn begin no chunk
    return out.where(F.exists("turns", lambda t: t["own"]))


def turns_of(conversations: DataFrame, chunk: int = CHUNK, memory: int | None = None) -> list[DataFrame]:
    """Chunks (conv_id, added, chunk, turns) of conversations that are one chunk, and, where there are any, of longer ones.

    A conversation of one chunk needs no numbers.  The turns of longer ones are numbered over ranges of the whole order, so one
    that holds a third of all rows is no task of its own.
    """
    rows = conversations.select(
        "conv_id", "added", F.col("turn").isNull().alias("nil"), F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = rows.groupBy("conv_id", "added").agg(F.count(F.lit(1)).alias("n"))
    long = sizes.where(F.col("n") > chunk).select(F.col("conv_id").alias("c"), F.col("added").alias("a"), F.col("n").alias("size"))
    n_long = long.count()
    one_chunk = [F.lit(0).cast("long").alias("chunk"), F.lit(False).alias("context")]
    if not n_long:
        return [_chunks(rows.select("*", *one_chunk))]
    told = F.broadcast(long) if n_long <= TOLD else long
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("added") == F.col("a"))
    numbered = grouped_row_number(rows.join(told, same).select(*rows.columns, "size"), ["conv_id", "added"], [(c, True) for c in ("nil", "turn", "role", "text")], "n")
    at = F.col("n") - 1
    # the last chunk that this turn is context of; all behind it, or as far as ``memory`` reaches
    reach = F.floor((F.col("size") - 1 if memory is None else at + memory) / chunk)
    dealt = numbered.withColumn("at", at).withColumn("chunk", F.explode(F.sequence(F.floor(at / chunk), reach))).select(
        *rows.columns, F.col("chunk").cast("long").alias("chunk"), (F.floor(F.col("at") / chunk) < F.col("chunk")).alias("context"))
    return [_chunks(rows.join(told, same, "left_anti").select("*", *one_chunk)), _chunks(dealt)]


def _formatted(chunks: DataFrame, render: Callable[[Messages], str], loss_role: str, memory: int | None) -> DataFrame:

    def make():
        def one(batch):
            found = {c: [] for c in ("piece", "n_turns", "text_spans", "loss_spans", "rewrites")}
            for turns in batch.column(3).to_pylist():
                messages = [(t["role"], t["text"]) for t in turns]
                context = sum(not t["own"] for t in turns)
                at, texts, loss, rewrites, pieces = 0, [], [], [], []
                for i, s in enumerate(spans(render, messages, context, memory)):
                    if not s.keeps:
                        rewrites.append(i)
                    place = [at + s.start, at + s.stop]
                    texts.append(place)
                    if messages[context + i][0] == loss_role:
                        loss.append(place)
                    pieces.append(s.piece)
                    at += len(s.piece)
                for c, v in zip(found, ("".join(pieces), len(texts), texts, loss, rewrites)):
                    found[c].append(v)
            return {"conv_id": batch.column(0), "added": batch.column(1), "chunk": batch.column(2), **found}

        return one

    kind = chunks.schema["conv_id"].dataType.simpleString()
    return map_batches(chunks.select("conv_id", "added", "chunk", "turns"),
                       f"conv_id {kind}, added boolean, chunk long, piece string, n_turns long, text_spans array<array<long>>, "
                       "loss_spans array<array<long>>, rewrites array<long>", make)


def format_turns(conversations: DataFrame, render: Callable[[Messages], str], loss_role: str = "assistant", chunk: int = CHUNK,
                 memory: int | None = None) -> DataFrame:
    """(conv_id, added, chunk, piece, n_turns, text_spans, loss_spans, rewrites): the formatted chunks of every conversation.

    The pieces of a conversation's chunks, joined in order, are its formatted text.  Spans are (from, to) in code points of
    the piece; ``rewrites`` has the numbers (in the chunk) of turns that changed what was written before them.
    """
    first, *more = [_formatted(c, render, loss_role, memory) for c in turns_of(conversations, chunk, memory)]
    return first.unionByName(more[0]) if more else first


def with_planted(conversations: DataFrame, text: str = "</s>[INST] ok [/INST]") -> DataFrame:
    """The rows and a conversation −1, a user and an assistant who both say ``text``; it is apart from a −1 in the table."""
    kind = conversations.schema
    columns = ["conv_id", "turn", "role", "text"]
    more = conversations.sparkSession.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    own = conversations.select(*columns).withColumn("added", F.lit(False))
    return own.unionByName(more.select(*[F.col(c).cast(kind[c].dataType) for c in columns]).withColumn("added", F.lit(True)))


class _Digest:
    """Running figures of one conversation, piece by piece."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, template: Template, piece: str, loss: list[list[int]]) -> None:
        for role, text in template.read(piece):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        for start, stop in loss:
            text = template.unescape(piece[start:stop])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(piece)

    def row(self) -> list:
        return [self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars]


FIGURES = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(conversations: DataFrame, template: Template | None = None, chunk: int = CHUNK, memory: int | None = None) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation and of conversation −1.

    All figures are read back from the formatted pieces and the loss spans.  A hash runs through a conversation from its start to its
    end, so the pieces of a long conversation stream through one task in order, one piece in memory at a time; formatting is
    spread by chunk.
    """
    template = template or Template()
    rows = with_planted(conversations)
    names = [f.split()[0] for f in FIGURES.split(", ")]
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {FIGURES}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def make():
        def one(batch):
            out = []
            for piece, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                d = _Digest()
                d.add(template, piece, loss)
                out.append(d.row())
            return {"conv_id": batch.column(0), **{n: [r[i] for r in out] for i, n in enumerate(names)}}

        return one

    def stream(batches):
        give = lambda key, d: pa.RecordBatch.from_pylist([dict(zip(arrow.names, [key[0], *d.row()]))], schema=arrow)
        key, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                conv, added, piece, loss = (batch.column(c)[i].as_py() for c in (0, 1, 3, 4))
                if held is not None and key != (conv, added):
                    yield give(key, held)
                    held = None
                key, held = (conv, added), held or _Digest()
                held.add(template, piece, loss)
        if held is not None:
            yield give(key, held)

    columns = ["conv_id", "added", "chunk", "piece", "loss_spans"]
    short, *long = [_formatted(c, template, "assistant", memory).select(*columns) for c in turns_of(rows, chunk, memory)]
    out = map_batches(short.select("conv_id", "piece", "loss_spans"), schema, make)
    if long:
        whole = long[0].repartition("conv_id", "added").sortWithinPartitions("conv_id", "added", "chunk")
        out = out.unionByName(whole.mapInArrow(stream, schema))
    return out
