"""Fingerprints, links and components against plain loops."""

import random
import re

import numpy as np
import pytest
import xxhash

from kerbside.llm.components import components, forest
from kerbside.llm.simhash import links, near_duplicates

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def near(prints, bits):
    return [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= bits]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize(("bits", "hot"), [(4, 4096), (4, 3), (1, 5), (3, 4), (6, 9)])
def test_links_connect_all_that_are_near(spark, bits, hot):
    random.seed(bits)
    prints = {0, (1 << 64) - 1, 1}
    for _ in range(12):  # clusters, and chains that leave them bit by bit
        centre = random.getrandbits(64)
        for _ in range(15):
            prints.add(centre)
            moved = centre
            for _ in range(random.randrange(1, 7)):
                moved ^= 1 << random.randrange(64)
            prints.add(moved)
            centre = random.choice([centre, moved])
    table = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = [(r.a, r.b) for r in links(table, bits, hot=hot).collect()]
    signed_prints = [signed(p) for p in prints]
    expected = plain_roots([(signed(a), signed(b)) for a, b in near(prints, bits)], signed_prints)
    assert plain_roots(found, signed_prints) == expected


def test_components_of_stars_and_chains(spark):
    random.seed(2)
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    pairs += [(random.randrange(200, 400), random.randrange(200, 400)) for _ in range(150)]
    random.shuffle(pairs)
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for p in pairs for n in p}
    assert found == {n: r for n, r in plain_roots(pairs, nodes).items() if n != r}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    a, b = forest(np.array([5, 1, 9], np.uint64), np.array([1, 3, 8], np.uint64))
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == [(3, 1), (5, 1), (9, 8)]
    assert len(forest(a[:0], b[:0])[0]) == 0


def test_documents_as_plain_loops(spark):
    random.seed(4)
    words = [f"w{i}" for i in range(40)]
    texts = [None, "", " \n", "one", "ONE", "one two three", "É a É b", "é a é b", "x " * 9000]
    for _ in range(25):
        base = [random.choice(words) for _ in range(random.randrange(3, 120))]
        for _ in range(4):
            base = list(base)
            base[random.randrange(len(base))] = random.choice(words)
            texts.append(" ".join(base))
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, "one", 1), (3, "other", 1), (None, "", 1), (None, "alone", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    prints = [plain_print(t) for _, t, _ in rows]
    roots = plain_roots(near(set(prints), 4), set(prints))
    first = {}
    for (i, _, _), p in zip(rows, prints, strict=True):
        if i is not None:
            first[roots[p]] = min(i, first.get(roots[p], i))
    expected = sorted((str(i), f"{p:016x}", str(first.get(roots[p]))) for (i, _, _), p in zip(rows, prints, strict=True))
    for hot in (4096, 4):
        found = near_duplicates(docs, hot=hot).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == expected


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0
