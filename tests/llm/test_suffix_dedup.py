"""Repeated bytes against a plain count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from kerbside.llm import suffix_dedup, suffixes
from kerbside.llm.suffix_dedup import remove_repeats
from kerbside.llm.suffixes import Hashed, merge_sort, repeated_windows


def plain(texts, length):
    texts = [(t or "").encode() for t in texts]
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        hit = [False] * len(t)
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                hit[i : i + length] = [True] * length
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        kept = bytes(b for b, h in zip(t, hit, strict=True) if not h)
        yield len(t), sum(hit), spans, hashlib.sha256(kept).hexdigest()


def corpus(seed, letters, n=40):
    random.seed(seed)
    make = lambda k: "".join(random.choice(letters) for _ in range(k))
    shared = [make(random.randrange(5, 80)) for _ in range(6)]
    texts = [None, "", "a", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 9, make(900)]
    for _ in range(n):
        parts = [random.choice(shared) if random.random() < 0.5 else make(random.randrange(30)) for _ in range(random.randrange(6))]
        texts.append("".join(parts))
    return texts + texts[6:12] + [texts[7]] * 8


def rows_of(found):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)


@pytest.mark.parametrize(("length", "letters", "hot"), [(20, "abcdefgh é", 2000), (20, "abcdefgh é", 3), (9, "ab", 5), (4, "ab", 2000), (50, "abc", 1)])
def test_as_plain_count(spark, length, letters, hot):
    texts = corpus(length, letters)
    rows = [(i if i % 9 else None, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rid string, spans int")
    expected = [(str(r[0]), *p) for r, p in zip(rows, plain(texts, length), strict=True)]
    assert rows_of(remove_repeats(docs, length=length, hot=hot).collect()) == sorted(expected)


def test_short_pieces_change_nothing(spark, monkeypatch):
    texts = corpus(1, "abc d")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = [(str(i), *p) for i, p in enumerate(plain(texts, 16))]
    for size in (40, 333):
        monkeypatch.setattr(suffix_dedup, "RUN_BYTES", size)
        assert rows_of(remove_repeats(docs, length=16).collect()) == sorted(expected)


def test_carried_rows_and_kept_bytes(spark):
    docs = spark.createDataFrame([(1, "x" * 8 + "abcdefgh", "k"), (2, "abcdefgh" + "y" * 7, "m")], "doc_id long, text string, kept string")
    found = {r.doc_id: r for r in remove_repeats(docs, length=8, carry=True).collect()}
    assert found[1].kept == b"x" * 8 and found[2].kept == b"y" * 7
    assert found[2].row.kept == "m" and found[1].row.text.endswith("abcdefgh")
    assert found[1].kept_text == "x" * 8
    assert "kept" not in remove_repeats(docs, length=8, with_kept=False).columns


def test_empty_table_and_long_text(spark):
    docs = spark.createDataFrame([(1, "ab" * 100_000), (2, "c" * 199), (3, "c" * 199)], "doc_id long, text string")
    assert remove_repeats(docs.limit(0)).count() == 0
    found = {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()}
    assert found == {1: 200_000, 2: 0, 3: 0}


def test_sorting_and_collisions():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    raw = data.tobytes()
    at = rng.permutation(390)
    segment = np.sort(rng.integers(0, 5, 390))
    keys = [raw[a : a + 10] for a in at]
    expected = [sum(k == k2 and s == s2 for k2, s2 in zip(keys, segment, strict=True)) > 1 for k, s in zip(keys, segment, strict=True)]
    whole = Hashed(data)
    begin = np.searchsorted(segment, segment)
    end = np.searchsorted(segment, segment, side="right")
    ordered = merge_sort(whole, at, begin, end, 10)
    for b in np.unique(begin):
        part = [raw[a : a + 10] for a in ordered[begin == b]]
        assert part == sorted(part)
    # A hash under which every byte is the same makes all windows equal: only the bytes can tell.
    for text in (whole, Hashed(data, values=np.zeros(256, np.uint64))):
        assert repeated_windows(text, at, segment, 10).tolist() == expected


def test_extension():
    text = Hashed(np.frombuffer(b"abcabdabcabc", np.uint8))
    assert text.extension(np.array([0, 0, 0]), np.array([3, 6, 1]), 5).tolist() == [2, 5, 0]
    assert suffixes.BASE % 2 == 1
