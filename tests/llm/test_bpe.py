"""Byte-level BPE against the public library, and exact round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from kerbside.llm.bpe import TextEncoder, encode_documents, load_ranks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
random.seed(5)
TEXTS = [
    None,
    "",
    "a",
    "hello world  foo\n\n bar's <|endoftext|>",
    "hello world  foo\n\n bar's <|endoftext|>",
    "a" * 5000,
    " " * 3000 + "x",
    "ab" * 700 + "abc" * 500,
    "".join(random.choice("abcdefgh") for _ in range(6000)),
    "é" * 900 + "日本語" * 300,
    "".join(chr(random.randrange(1, 0xD7FF)) for _ in range(3000)),
]


@pytest.fixture(scope="module")
def library():
    ranks = {token: rank for rank, token in enumerate(load_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_documents_as_the_library(spark, library):
    rows = [(i, t, "other", 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string, n_tokens int")
    found = {r.doc_id: r for r in encode_documents(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = library.encode_ordinary(text or "")
        assert list(found[i].ids) == ids
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_empty_table_and_null_id(spark):
    docs = spark.createDataFrame([(None, "x")], "doc_id long, text string")
    assert encode_documents(docs, RANKS, public_tokenizers.PATTERN).count() == 1
    assert encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("letters", ["ab", "abc ", "tehino", "0123456789"])
def test_random_pieces(library, letters):
    encoder = TextEncoder(load_ranks(RANKS), public_tokenizers.PATTERN)
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(400))) for _ in range(100)]
    ids, counts, _ = encoder([t.encode() for t in texts])
    at = 0
    for text, n in zip(texts, counts, strict=True):
        assert ids[at : at + n].tolist() == library.encode_ordinary(text)
        at += n


def test_merges_that_lower_the_rank():
    """A vocabulary in which a merged token takes part in a pair of smaller rank."""
    tokens = [bytes([b]) for b in range(256)] + [b"aba", b"ab", b"abab"]
    ranks = {token: rank for rank, token in enumerate(tokens)}
    own = tiktoken.Encoding("odd", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    encoder = TextEncoder(tokens, r"[\s\S]+")
    for text in ["ab" * n + "b" * (n % 3) for n in range(1, 120)]:
        assert encoder([text.encode()])[0].tolist() == own.encode_ordinary(text)
