"""Packed rows: exact round trips, and the best fit against plain loops."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from kerbside.llm import packing
from kerbside.llm.bpe import load_ranks
from kerbside.llm.packing import RoomTree, best_fit, pack

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def plain_best_fit(sizes, capacity):
    rows, room = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in range(len(rows)) if room[r] >= sizes[i]]
        if fits:
            r = min(fits, key=lambda r: room[r])
            rows[r].append(i)
            room[r] -= sizes[i]
        else:
            rows.append([i])
            room.append(capacity - sizes[i])
    return rows


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_best_fit_as_plain_loops(capacity):
    random.seed(capacity)
    for _ in range(20):
        sizes = np.array([random.randrange(1, capacity + 1) for _ in range(80)])
        found, expected = best_fit(sizes, capacity), plain_best_fit(sizes.tolist(), capacity)
        assert sorted(i for row in found for i in row) == list(range(80))
        # Rows with equal room are interchangeable, so only what each row holds in all is determined.
        filled = lambda rows: sorted(int(sizes[row].sum()) for row in rows)
        assert filled(found) == filled(expected)


def test_room_tree():
    random.seed(0)
    tree, held = RoomTree(50), []
    for n in range(2000):
        if random.random() < 0.6:
            room = random.randrange(1, 51)
            tree.put(n, room)
            held.append(room)
        else:
            least = random.randrange(1, 53)
            fits = [r for r in held if r >= least]
            found = tree.take(least)
            assert (found and found[1]) == (min(fits) if fits else None)
            if found:
                held.remove(found[1])


def unpack(rows, capacity):
    tokens = {}
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == capacity and r.n_tokens == r.cu_seqlens[-1] <= capacity
        assert (ids[r.n_tokens :] == 50256).all()
        for doc, offset, b, e in zip(r.doc_ids, r.offsets, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert e > b and places[b:e].tolist() == list(range(e - b))
            tokens.setdefault(doc, {})[offset] = ids[b:e].tolist()
    return {d: [t for o in sorted(parts) for t in parts[o]] for d, parts in tokens.items()}


@pytest.mark.parametrize(("capacity", "block"), [(64, 1 << 22), (64, 500), (2048, 1 << 22)])
def test_round_trip(spark, monkeypatch, capacity, block):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", block)
    random.seed(capacity)
    texts = [None, "", "one", "<|endoftext|>", "é" * 700] + ["w x yz " * random.randrange(90) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, b"") for i, t in enumerate(texts)], "doc_id long, text string, ids binary")
    rows = pack(docs, RANKS, public_tokenizers.PATTERN, capacity=capacity).collect()
    ranks = {token: rank for rank, token in enumerate(load_ranks(RANKS))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert unpack(rows, capacity) == {i: library.encode_ordinary(t) for i, t in enumerate(texts) if t}
    assert len({r.row_id for r in rows}) == len(rows)


def test_empty_table_and_null_id(spark):
    docs = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert pack(docs, RANKS, public_tokenizers.PATTERN).first().doc_ids == [None]
    assert pack(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_rows_depend_on_the_texts_and_not_on_the_partitions(spark):
    random.seed(5)
    docs = spark.createDataFrame([(i, "w x yz " * random.randrange(1, 90)) for i in range(300)], "doc_id long, text string")
    one, many = (
        {r.row_id: (r.doc_ids, r.offsets, bytes(r.ids)) for r in pack(docs.repartition(n), RANKS, public_tokenizers.PATTERN).collect()} for n in (1, 64)
    )
    assert one == many
    rows = pack(docs.repartition(64), RANKS, public_tokenizers.PATTERN).collect()
    assert sum(r.n_tokens for r in rows) > 0.95 * 2048 * (len(rows) - 1)


def test_a_third_of_all_rows_is_one_row(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_BYTES", 500)
    rows = [(i, f"text number {i}") for i in range(200)] + [(7, "one hot row")] * 100
    found = pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), RANKS, public_tokenizers.PATTERN, capacity=8).collect()
    hot = [r.row_id >> 32 for r in found for i in r.doc_ids if i == 7]
    assert len(set(hot)) > 3 and max(map(hot.count, hot)) < 50
    assert len({r.row_id for r in found}) == len(found)
    held = [i for r in found for i, offset in zip(r.doc_ids, r.offsets, strict=True) if offset == 0]
    assert sorted(held) == sorted(i for i, _ in rows)
