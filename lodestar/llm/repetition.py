"""Quality rules from a suffix array: how much of a text repeats, and how long its longest repeat is."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import SPACE, map_batches, word_slices

#: Words of the base rule's windows, and of the shortest repeat that the verdict counts.
BASE_WINDOW, LEAST = 8, 5
#: A text is rejected if repeats cover more than this share of its words ...
MOST_COVERED = 0.35
#: ... or its longest repeat has more words than this and also more than this share of them.
LONGEST, LONGEST_SHARE = 50, 0.20
#: ... or its longest repeat has more words than this, however long the text is.
LONGEST_ANYWHERE = 200
#: Words of the texts whose suffixes are sorted together.
BATCH_WORDS = 100_000


def repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each place, the length of the longest run of words that starts there and occurs again in its document.

    ``ids`` are word numbers and ``doc`` the rising document numbers of the words.  The suffix array is
    made by doubling: suffixes are ranked by their first word, then by 2, 4, ... words, and only those
    whose rank is still shared are sorted again.  A suffix ends with its document, and the first
    ranks tell documents apart, so suffixes of different documents never share a rank.  The longest
    common prefixes of neighbours come from the ranks of all rounds, largest step first; the longest
    repeat at a place is the larger of its suffix's two neighbours' prefixes.
    """
    n = len(ids)
    if not n:
        return np.zeros(0, dtype=np.int64)
    end = np.searchsorted(doc, doc, side="right")
    key = doc.astype(np.int64) * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order][1:] != key[order][:-1]]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = head
    rounds, step = [], 1
    while True:
        rounds.append((step, rank))
        shared = np.bincount(rank, minlength=n)[rank] > 1
        if not shared.any():
            break
        todo = np.flatnonzero(shared)
        ahead = np.minimum(todo + step, n - 1)
        second = np.where(todo + step < end[todo], rank[ahead], -1)
        pos = np.lexsort((second, rank[todo]))
        todo, first, second = todo[pos], rank[todo[pos]], second[pos]
        at = np.arange(len(todo))
        group = np.maximum.accumulate(np.where(np.r_[True, first[1:] != first[:-1]], at, 0))
        part = np.maximum.accumulate(np.where(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])], at, 0))
        rank = rank.copy()
        rank[todo] = first + part - group
        step *= 2
    suffix = np.empty(n, dtype=np.int64)
    suffix[rank] = np.arange(n)
    a, b = suffix[:-1].copy(), suffix[1:].copy()
    stop = end[a]
    prefix = np.zeros(max(0, n - 1), dtype=np.int64)
    live = np.flatnonzero(doc[a] == doc[b])
    for step, r in reversed(rounds[:-1]):
        i, j = a[live], b[live]
        inside = np.maximum(i, j) < stop[live]
        same = np.zeros(len(live), dtype=bool)
        same[inside] = r[i[inside]] == r[j[inside]]
        hit = live[same]
        prefix[hit] += step
        a[hit] += step
        b[hit] += step
    longest = np.zeros(n, dtype=np.int64)
    if n > 1:
        np.maximum.at(longest, suffix[:-1], prefix)
        np.maximum.at(longest, suffix[1:], prefix)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Whether each word lies in a repeat of at least ``least`` words: the union of the repeats' spans."""
    at = np.flatnonzero(longest >= least)
    edge = np.zeros(len(longest) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + longest[at], -1)
    return np.cumsum(edge[:-1]) > 0


def figures(texts: list[str | None]) -> list[tuple]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, longest_repeat) of each text."""
    ids: dict[bytes, int] = {}
    numbers, sizes, rest = [], [], []
    for text in texts:
        text = text or ""
        data = text.encode()
        size = 0
        for words in word_slices(data):
            numbers += [ids.setdefault(w, len(ids)) for w in words]
            size += len(words)
        sizes.append(size)
        seen: set[bytes] = set()
        lines = dups = 0
        for line in data.split(b"\n"):
            if line.strip():
                lines += 1
                seen.add(line)
        dups = lines - len(seen)
        rest.append((len(text) - sum(map(data.count, (bytes([c]) for c in SPACE))), sum(map(text.count, "#*$%&|<>")), dups))
    doc = np.repeat(np.arange(len(texts)), sizes)
    longest = repeats(np.array(numbers, dtype=np.int64), doc)
    n = len(texts)
    base = np.bincount(doc[covered(longest, BASE_WINDOW)], minlength=n)
    inside = np.bincount(doc[covered(longest, LEAST)], minlength=n)
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, doc, longest)
    return [(s, *r, int(b), int(c), int(m)) for s, r, b, c, m in zip(sizes, rest, base, inside, most)]


def verdict(n_words: int, n_covered: int, longest: int) -> bool:
    """Whether a text passes the method's own limits."""
    return not (n_covered > MOST_COVERED * n_words or longest > LONGEST and longest > LONGEST_SHARE * n_words
                or longest > LONGEST_ANYWHERE)


def quality_rules(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, base figures, base_failed, kept, n_covered, longest_repeat) of every row.

    Whole texts are read; each is compared with itself alone, so there is no shuffle.  Null text has
    no words and fails the base rule, as do fewer than 20 words.  ``kept`` is false for what fails the
    base rule, else the verdict on the covered share and the longest repeat.  Repeated rows and null
    ids stay; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]

    def make():
        def one(batch: pa.RecordBatch):
            rows, run, held = [], [], 0
            for value in batch.column(1):
                t = value.as_py()
                run.append(t)
                held += len(t or "") // 5 + 1
                if held >= BATCH_WORDS:
                    rows += figures(run)
                    run, held = [], 0
            rows += figures(run) if run else []
            made = {name: list(col) for name, col in zip(names, zip(*rows))}
            failed = [r[0] < 20 or 100 * r[4] > 30 * r[0] for r in rows]
            return made | {id_col: batch.column(0), "base_failed": failed,
                           "kept": [not f and verdict(r[0], r[5], r[6]) for f, r in zip(failed, rows)]}
        return one

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{n} long" for n in names[:5]) + ", base_failed boolean, kept boolean, n_covered long, longest_repeat long"
    return map_batches(docs.select(F.col(id_col), F.col(text)), schema, make)
