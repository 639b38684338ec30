"""Shards against sorting all rows at once."""

import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from kerbside.llm import sharding
from kerbside.llm.queries import op4_sharding
from kerbside.llm.sharding import shard_by_bytes, sized


def check(spark, rows, shards=16):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, shard string, key int")
    found = shard_by_bytes(docs, shards=shards).collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    data = [(t or "").encode() for _, t in rows]
    expected = [(i, len(t) + 1, zlib.crc32(t)) for (i, _), t in zip(rows, data, strict=True)]
    assert sorted(map(key, ((r.doc_id, r.size, r.text_crc32) for r in found))) == sorted(map(key, expected))
    slots = defaultdict(list)
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # In the order of shard and slot, the rows are sorted by their key.
    keys = {(r.doc_id, r.text_crc32): r.key for r in sized(docs, "doc_id", "text", False).collect()}
    ordered = [keys[r.doc_id, r.text_crc32] for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)
    totals = Counter()
    for r in found:
        totals[r.shard] += r.size
    return [totals[i] for i in range(shards)], found


@pytest.mark.parametrize("probes", [1, 16])
def test_even_bytes(spark, monkeypatch, probes):
    monkeypatch.setattr(sharding, "PROBES", probes)
    random.seed(1)
    rows = [(i, "é" * random.randrange(50)) for i in range(4000)]
    totals, _ = check(spark, rows)
    assert max(totals) - min(totals) <= 0.06 * np.mean(totals)  # groups of equal texts stay whole


def test_a_third_of_all_rows_is_one_text(spark):
    random.seed(2)
    rows = [(i, "hot" * 10 if i % 3 == 0 else f"{i} " * random.randrange(10)) for i in range(6000)]
    totals, found = check(spark, rows)
    assert max(totals) - min(totals) <= 0.06 * np.mean(totals)
    assert len({r.shard for r in found if r.text_crc32 == zlib.crc32(b"hot" * 10)}) > 3


def test_a_third_of_all_rows_is_one_row(spark):
    random.seed(4)
    rows = [(7, "hot" * 10) if i % 3 == 0 else (i, f"{i} " * random.randrange(10)) for i in range(6000)]
    totals, found = check(spark, rows)
    assert max(abs(t - np.mean(totals)) for t in totals) <= 0.03 * np.mean(totals)
    assert len({r.shard for r in found if r.doc_id == 7}) > 3
    # Also of input that is more than a scan, whose rows may come in another order each time.
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    slots = defaultdict(list)
    for r in shard_by_bytes(docs, carry=True).collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == 6000


def test_small_groups_stay_whole(spark):
    random.seed(3)
    rows = [(i, f"text {i // 3}") for i in range(6000)]
    _, found = check(spark, rows)
    shards = defaultdict(set)
    for r in found:
        shards[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_odd_rows(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, None), (None, ""), (2, "x" * 100_000), (3, None)]
    check(spark, rows)
    check(spark, rows, shards=2)
    check(spark, [(7, "only")])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert shard_by_bytes(empty).count() == 0


def test_carried_rows(spark):
    docs = spark.createDataFrame([(1, "a", "k")], "doc_id long, text string, slot string")
    row = shard_by_bytes(docs, carry=True).first()
    assert row.row.slot == "k" and row.row.text == "a" and row.slot == 0


def test_carried_rows_are_sized_as_they_arrive(spark):
    rows = [(1, "a"), (1, "a"), (None, None), (None, ""), (2, "é" * 100_000), *[(i, f"text {i // 3}") for i in range(500)]]
    docs = spark.createDataFrame(rows, "doc_id long, body string")
    found = shard_by_bytes(docs, text_col="body", carry=True).collect()
    assert sorted(((r.row.doc_id, r.row.body) for r in found), key=str) == sorted(rows, key=str)
    for r in found:
        data = (r.row.body or "").encode()
        assert (r.doc_id, r.size, r.text_crc32) == (r.row.doc_id, len(data) + 1, zlib.crc32(data))
    same = {(r.doc_id, r.text_crc32, r.shard, r.slot) for r in shard_by_bytes(docs, text_col="body").collect()}
    assert {(r.doc_id, r.text_crc32, r.shard, r.slot) for r in found} == same


def test_the_query_exchanges_whole_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    node = op4_sharding(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Window":
        node = node.children().apply(0)
    numbered = {a.name(): a.dataType().json() for a in (node.output().apply(i) for i in range(node.output().size()))}
    assert [f["name"] for f in json.loads(numbered["row"])["fields"]] == docs.columns
