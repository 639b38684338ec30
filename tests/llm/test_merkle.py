"""The manifest against plain recursion over all leaves, and against its SQL."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

from kerbside.llm import merkle
from kerbside.llm.queries import ORACLES, op12_merkle_manifest
from verification.compare import difference

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """The root, and per leaf the siblings: (stands left, digest), or None."""
    if len(nodes) == 1:
        return nodes[0], [[]]
    root, above = plain_tree([h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)])
    steps = []
    for i in range(len(nodes)):
        sibling = (i % 2 == 1, nodes[i ^ 1]) if i ^ 1 < len(nodes) else None
        steps.append([sibling, *above[i // 2]])
    return root, steps


def plain_fold(node, steps):
    for step in steps:
        node = h(node) if step is None else h(step[1], node) if step[0] else h(node, step[1])
    return node


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    trees = {}
    for lang, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[lang] = plain_tree([plain_leaf(r) for r in own])
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    root, above = plain_tree([trees[g][0] for g in order])
    out = []
    for k, lang in enumerate(order):
        for row, steps in zip(groups[lang], trees[lang][1], strict=True):
            steps, leaf = steps + above[k], plain_leaf(row)
            changed = list(row)
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                changed[3] += 1
            found = plain_fold(plain_leaf(changed), steps)
            proof = h(*(s[1] for s in steps if s))
            out.append((row[0], leaf, trees[lang][0], root, proof, found, found == root))
    return sorted(out, key=str)


def made(n, seed):
    random.seed(seed)
    langs = [None, "", "en", "en", "en", "de", "é", "0", "1"]
    rows = [(i, random.choice([None, "web"]), random.choice(langs), random.choice([None, i, 0]), random.choice([None, "", "é" * i, "x:1"])) for i in range(n)]
    return rows


def found(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(map(tuple, merkle.verify(docs).collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 70])
@pytest.mark.parametrize("block", [1, 3])
def test_as_plain_recursion(spark, monkeypatch, n, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = made(n, n)
    assert found(spark, rows) == plain(rows)


def test_repeated_rows_null_ids_and_ties(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 2)
    rows = [(7, "s", "en", 1, "same")] * 25 + [(None, None, None, None, None)] * 3 + [(7, "s", "en", 1, f"other {i}") for i in range(4)]
    rows += [(1, "s", "en", 2, "long " * 100_000)]
    assert found(spark, rows) == plain(rows)


def test_only_tampered_rows_fail(spark):
    rows = [(i, "s", "en", 5, "text") for i in range(60)]
    for row in found(spark, rows):
        assert row[6] == (zlib.crc32(str(row[0]).encode()) % 7 != 0)


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert merkle.verify(docs).collect() == []
    rows = made(20, 3)
    more = [(*row, i, "at", "x") for i, row in enumerate(rows)]
    docs = spark.createDataFrame(more, SCHEMA + ", tree int, leaf string, proof string")
    assert sorted(map(tuple, merkle.verify(docs).collect()), key=str) == plain(rows)


def test_missing_coordinates_are_fewest_and_enough():
    random.seed(5)
    for n in (1, 2, 5, 16, 23):
        leaves = [h(str(i)) for i in range(n)]
        root, steps = plain_tree(leaves)
        nodes = {(0, i): d for i, d in enumerate(leaves)}
        for level in range(merkle.height(n)):
            row = [nodes[level, i] for i in range(-(-n // 2**level))]
            nodes.update({(level + 1, i): h(*row[2 * i : 2 * i + 2]) for i in range(-(-len(row) // 2))})
        for _ in range(20):
            at = np.array(sorted(random.sample(range(n), random.randint(1, n))))
            wanted = merkle.missing(at, n)
            needed = {(k, (int(i) >> k) ^ 1) for i in at for k in range(merkle.height(n)) if (int(i) >> k) ^ 1 < -(-n // 2**k)}
            given = {(k, int(i) >> k) for i in at for k in range(merkle.height(n) + 1)}
            assert sorted(wanted) == sorted(needed - given)
            levels, top = merkle.interiors(at, [leaves[i] for i in at], n, {c: nodes[c] for c in wanted})
            assert top == root
            proofs = merkle.expand(at, levels, n).to_pylist()
            assert [[None if s["digest"] is None else (s["left"], s["digest"]) for s in p] for p in proofs] == [steps[i] for i in at]


def test_as_its_sql(spark):
    name = "op12_merkle_manifest"
    assert difference(spark, "/root/testdata/sf0.001", op12_merkle_manifest, ORACLES[name]) is None
