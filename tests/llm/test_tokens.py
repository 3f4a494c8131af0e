"""Token counts and byte-level BPE against the libraries themselves."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from lodestar.llm import bpe, counting
from lodestar.session import table
from tests.conftest import SF_SMALL

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", None, " ", "  \n\n  a", "a  b　  c", "x\x1c y\x85  z", "don't 're 's  it", "<|endoftext|> a <|endoftext|>b",
       "a" * 5000, "ab1 " * 3000, "日本語テキスト" * 700, "   x    y", "🙂🙃 " * 300, "tab\t\tnew\r\n\r\nline  ", "é" * 300 + " ß"]


@pytest.fixture(scope="module")
def lib():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(lib, text):
    ids = lib.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_counts_match_library(spark, make_docs):
    texts = ODD + [r.text for r in table(spark, SF_SMALL, "documents").collect()]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = make_docs([(i % 50 or None, x, "s") for i, x in enumerate(texts)])
    got = counting.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    want = [(i % 50 or None, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in enumerate(texts)]
    key = lambda r: (r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


@pytest.mark.parametrize("stride,overlap", [(64, 16), (200, 40), (bpe.STRIDE, bpe.OVERLAP)])
def test_digests_match_library(spark, make_docs, lib, stride, overlap):
    texts = ODD + [r.text for r in table(spark, SF_SMALL, "documents").limit(60).collect()] + ["w" * 1000 + " end", None]
    docs = make_docs([(i, x, None) for i, x in enumerate(texts)] + [(0, ODD[12], None), (None, ODD[12], None)])
    got = bpe.digests(docs, RANKS, public_tokenizers.PATTERN, stride=stride, overlap=overlap).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = ODD[12] if r.doc_id is None or (r.doc_id == 0 and r.n_tokens) else texts[r.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(lib, text)


def test_pieces_are_short_and_count_as_the_whole():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    spaced = "word " * 20_000 + "a\u00a0 b\u00a0\u00a0  c" + " word" * 20_000  # odd spaces make no difference elsewhere
    japanese = "日本語のテキスト、「かぎ」と記号。" * 2_000
    for text, longest in ((spaced, 20), (japanese, counting.LONG_PIECE)):
        pieces = counting.pieces_of(text)
        assert "".join(pieces) == text and max(map(len, pieces)) <= longest
        assert sum(map(n, pieces)) == n(text) == counting.Lengths(public_tokenizers.path("byte_bpe_50k.json")).of([text])[0]
    rng = np.random.default_rng(0)
    letters = ["a", "日", "é", "1", "'", "\u2019", "s", "ll", "!", "。", "(", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "\ufeff", "<|endoftext|>", "-"]
    old = counting.LONG_PIECE
    try:
        for _ in range(1500):
            counting.LONG_PIECE = int(rng.choice([1, 3, 256]))
            text = "".join(rng.choice(letters, int(rng.integers(1, 30))))
            pieces = counting.pieces_of(text)
            assert "".join(pieces) == text and sum(map(n, pieces)) == n(text), repr(text)
    finally:
        counting.LONG_PIECE = old


def test_columns_with_names_of_the_work(spark, make_docs, lib):
    from pyspark.sql import functions as F

    from lodestar.llm import mixing, simhash

    texts = ["a b c d e f " * 30, "x" * 70_000 + " y", "other words here and there now", None, ""]
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    odd = docs.select("*", *[F.lit(f"mine {c}").alias(c) for c in ("_k1", "_k2", "_time", "_times", "_copies", "_run", "_key", "key", "row", "copy", "piece")])
    for made in (simhash.keep_one(odd), mixing.mixed_copies(odd), bpe.encode_documents(odd, RANKS, public_tokenizers.PATTERN)):
        rows = made.collect()
        assert rows and all(r[c] == f"mine {c}" for r in rows for c in odd.columns[len(docs.columns):])
    ids = {r.doc_id: r.ids for r in bpe.encode_documents(odd, RANKS, public_tokenizers.PATTERN).collect()}
    assert all(bytes(ids[i] or b"") == np.array(lib.encode_ordinary(t or ""), dtype="<u4").tobytes() for i, t in enumerate(texts))


def test_empty_tables(make_docs):
    assert bpe.digests(make_docs([]), RANKS, public_tokenizers.PATTERN).count() == 0
    assert counting.token_counts(make_docs([]), public_tokenizers.path("byte_bpe_50k.json")).count() == 0
