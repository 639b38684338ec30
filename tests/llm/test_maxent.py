"""Counts and base scores against plain loops; the model against its definition and its base."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbside.llm import maxent
from kerbside.llm.common import copy_numbers
from kerbside.llm.maxent import (
    CLASSES,
    FEATURES,
    ROWS,
    Tokens,
    class_log_probabilities,
    class_of,
    defaults,
    factors,
    hashes_of,
    in_blocks,
    leaf_of,
    look_up,
    score_texts,
    scorer,
    tokens_of,
    update,
    word_class,
)


def plain(rows):
    split = [tokens_of((t or "").encode()) for _, t in rows]
    trains = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for i, _ in rows]
    counts = Counter(w for words, t in zip(split, trains, strict=True) if t for w in words)
    n, v = sum(counts.values()), len(counts)
    for (i, _), words, t in zip(rows, split, trains, strict=True):
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        yield str(i), not t, len(words), sum(counts[w] > 0 for w in words), n, round(score, 6)


def documents():
    random.seed(8)
    words = ["A", "b", "ç", "dd", "É", "x.", "longer", "-"]
    texts = [None, "", "A a\x0bA\x1c", "word " * 3000]
    texts += [" ".join(random.choice(words) + random.choice(["", "", str(i)]) for _ in range(random.randrange(60))) for i in range(80)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(3, "again"), (5, rows[5][1]), (5, rows[5][1]), (None, "b ç"), (None, None)]


@pytest.mark.parametrize("block_bytes", [8 << 20, 300])
def test_counts_and_base_as_plain_loops(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(maxent, "BLOCK_BYTES", block_bytes)
    rows = documents()
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, score int, word string")
    found = score_texts(docs).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert got == sorted(plain(rows))
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_a_third_of_all_rows_is_one_row(spark, monkeypatch):
    monkeypatch.setattr(maxent, "BLOCK_BYTES", 300)
    rows = [(i, f"some words {i} b") for i in range(100)] + [(3, "hot words")] * 30 + [(9, "hot held words")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = in_blocks(docs.coalesce(1), 300).groupBy("block").agg({"text": "count"}).collect()
    assert len(cut) > 5 and max(r[1] for r in cut) < 30
    for table in (docs, docs.repartition(3)):
        found = score_texts(table).collect()
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
        assert got == sorted(plain(rows))


def test_copies_get_numbers_of_their_own(spark):
    docs = spark.createDataFrame([(h,) for h in [1, 2, 1, 1, 3, 2]], "place long").coalesce(1)
    found = [tuple(r) for r in copy_numbers(docs, "place").collect()]
    assert sorted(found) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (3, 0)]


def test_hashes_and_classes_of_words(spark, monkeypatch):
    monkeypatch.setattr(maxent, "HASHED_WORDS", 2)
    words = [b"a", b"bc", maxent.END, "çd".encode(), b"a" * 50]
    tokens = Tokens([b"a bc", "çd ".encode() + b"a" * 50])
    assert sorted(hashes_of(words).view(np.uint64).tolist()) == sorted(set(tokens.hashes.tolist()))
    table = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    assert [r[0] for r in table.select(class_of(F.col("word"))).collect()] == [word_class(w) for w in words]


def test_a_word_not_asked_for_fails():
    known = np.array([2, 5], np.uint64)
    assert look_up(known, np.array([7, 8]), np.array([5, 2, 5], np.uint64)).tolist() == [8, 7, 8]
    with pytest.raises(ValueError):
        look_up(known, np.array([7, 8]), np.array([5, 6], np.uint64))


def test_empty_table_and_no_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert score_texts(docs.limit(0)).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = score_texts(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)


def test_probabilities_sum_to_one_and_gradients_are_right():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(FEATURES * ROWS, CLASSES)).astype(np.float32)
    tokens = Tokens([b"a b c a b", b"", b"d a"])
    logs = class_log_probabilities(weights, tokens.rows)
    assert np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-5)
    assert tokens.classes.tolist() == [word_class(w) for t in (b"a b c a b", b"", b"d a") for w in tokens_of(t)]
    words, number = tokens.distinct()
    assert [words[i] for i in number] == [w for t in (b"a b c a b", b"", b"d a") for w in tokens_of(t)]
    # The first token of each text has the same history, whatever stands before it.
    assert (tokens.rows[:, 0] == tokens.rows[:, 6]).all() and (tokens.rows[:, 0] == tokens.rows[:, 7]).all()
    loss = lambda w: -class_log_probabilities(w, tokens.rows)[np.arange(10), tokens.classes].sum()
    squares = np.zeros_like(weights)
    before, moved = loss(weights), weights.copy()
    update(moved, squares, tokens.rows, tokens.classes)
    assert loss(moved) < before
    row, k = tokens.rows[1, 0], 3
    shifted = weights.astype(np.float64)
    shifted[row, k] += 1e-4
    slope = (loss(shifted) - loss(weights.astype(np.float64))) / 1e-4
    assert abs(abs(slope) - math.sqrt(squares[row, k])) < 1e-2


def test_better_than_its_base_on_held_out_texts(spark):
    found = score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in found) > sum(r.base_score for r in found)
    assert np.mean([r.score > r.base_score for r in found]) > 0.8


def test_what_is_learned_depends_on_the_texts_and_not_on_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(maxent, "BLOCK_BYTES", 100_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, many = ({r.doc_id: r.score for r in score_texts(docs.repartition(n)).collect()} for n in (1, 64))
    assert one.keys() == many.keys()
    assert max(abs(one[i] - many[i]) / abs(one[i]) for i in one) < 1e-6


def test_a_texts_score_word_by_word(spark, monkeypatch):
    """With weights that are given: P(class | history) by a softmax in plain Python, P(word | class) by counts."""
    weights = np.asfortranarray(np.random.default_rng(2).normal(size=(FEATURES * ROWS, CLASSES)).astype(np.float32))
    monkeypatch.setattr(maxent, "train", lambda *_: weights)
    rows = [(i, t) for i, t in documents() if len(t or "") < 2000][:40]
    found = score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    counts = Counter(w for i, t in rows for w in tokens_of((t or "").encode()) if zlib.crc32(str(i).encode()) % 7 != 2)
    n, v = Counter(), Counter(map(word_class, counts))
    for word, times in counts.items():
        n[word_class(word)] += times
    expected = []
    for i, text in rows:
        words, total = tokens_of((text or "").encode()), 0.0
        for word, features in zip(words, Tokens([(text or "").encode()]).rows.T, strict=True):
            z = [sum(float(weights[row, k]) for row in features) for k in range(CLASSES)]
            own = word_class(word)
            total += z[own] / math.log(10) - math.log10(sum(map(math.exp, z)))
            total += math.log10((counts[word] + 1) / (n[own] + v[own] + 1))
        expected.append((i, total))
    got = sorted((r.doc_id, r.score) for r in found)
    assert [i for i, _ in got] == [i for i, _ in sorted(expected)]
    assert [s for _, s in got] == pytest.approx([s for _, s in sorted(expected)], rel=1e-5)


def test_parts_of_a_block_come_back_as_they_were_dealt(spark, monkeypatch):
    monkeypatch.setattr(maxent, "TOKEN_BYTES", 50)
    texts = [b"a b", b"", b"c " * 60, b"d e f", b"a b"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(t.decode() for t in texts), pa.array([False, False, False, False, True]), pa.array([1, 1, 1, 2, 2], pa.int64())],
        names=["text", "kept", "block"],
    )
    parts = list(maxent.featurized(maxent.featurize([batch])))
    assert [block for block, _, _ in parts] == [1, 1, 2, 2]
    whole = [Tokens(texts[:2]), Tokens(texts[2:3]), Tokens(texts[3:4]), Tokens(texts[4:])]
    for (_, rows, classes), tokens in zip(parts, whole, strict=True):
        assert (rows == tokens.rows).all() and (classes == tokens.classes).all()


def test_history_chooses_among_the_words_of_a_class(spark):
    """Both words are of one class and equally frequent; only P(word | class, history) can tell them apart."""
    assert word_class(b"alphaing") == word_class(b"betaing")
    random.seed(3)
    pairs = ["north alphaing", "south betaing"]
    texts = [" ".join(random.choice(pairs) for _ in range(40)) for _ in range(300)]
    fold = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(400)]
    train, held = ([i for i, h in enumerate(fold) if h == own] for own in (False, True))
    rows = [*zip(train, texts, strict=False), (held[0], "north alphaing south betaing"), (held[1], "north betaing south alphaing")]
    score = {r.doc_id: r.score for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()}
    assert score[held[0]] > score[held[1]] + 0.5


def plain_hash(value, node, level, n):
    return ((value << maxent.DIGIT * (level + 1) | node) * 0x9E3779B1 % (1 << 32)) >> (33 - n.bit_length())


def test_a_texts_score_with_weights_of_both_factors(spark, monkeypatch):
    """The words of a class by a sum over all of them: one term for each word, one for what is unseen in each leaf."""
    n_rows = 256
    below = maxent.LEVELS * len(maxent.WORD_FEATURES) * n_rows
    weights = np.random.default_rng(4).normal(size=(FEATURES * ROWS + below, CLASSES)).astype(np.float32)
    monkeypatch.setattr(maxent, "train", lambda *_: weights)
    rows = [(i, t) for i, t in documents() if len(t or "") < 2000][:30]
    found = score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    counts = Counter(w for i, t in rows for w in tokens_of((t or "").encode()) if zlib.crc32(str(i).encode()) % 7 != 2)
    seen = list(counts)
    leaf = {w: int(maxent.leaves_of(hashes_of([w]).view(np.uint64))[0]) for i, t in rows for w in tokens_of((t or "").encode())}
    mass = Counter()
    for w in seen:
        mass[word_class(w), leaf[w]] += counts[w] + 1
    parts = factors(weights)
    usual = {(k, x): mass[k, x] + 1 / maxent.LEAVES for k in range(CLASSES) for x in range(maxent.LEAVES)}

    def choice(level, k, x, features):
        """The exponential of the weights of a leaf's digit, and its share among those of its node."""
        node, size = k * CLASSES**level + x // CLASSES ** (maxent.LEVELS - level), CLASSES ** (maxent.LEVELS - level - 1)
        at = [plain_hash(int(features[f]) - f * ROWS, node, level, n_rows) + i * n_rows for i, f in enumerate(maxent.WORD_FEATURES)]
        first = x // (size * CLASSES) * size * CLASSES
        z = [
            math.exp(sum(float(parts[level + 1][row, d]) for row in at)) * sum(usual[k, first + d * size + j] for j in range(size))
            for d in range(CLASSES)
        ]
        return z[x // size % CLASSES] / sum(z)

    def of_leaf(k, x, features):
        return math.prod(choice(level, k, x, features) for level in range(maxent.LEVELS))

    expected = []
    for i, text in rows:
        words, total = tokens_of((text or "").encode()), 0.0
        for word, features in zip(words, Tokens([(text or "").encode()]).rows.T, strict=True):
            z = [sum(float(weights[row, k]) for row in features) for k in range(CLASSES)]
            own, x = word_class(word), leaf[word]
            total += z[own] / math.log(10) - math.log10(sum(map(math.exp, z)))
            total += math.log10(of_leaf(own, x, features) * (counts[word] + 1) / usual[own, x])
        expected.append((i, total))
    got = sorted((r.doc_id, r.score) for r in found)
    assert [i for i, _ in got] == [i for i, _ in sorted(expected)]
    assert [s for _, s in got] == pytest.approx([s for _, s in sorted(expected)], rel=1e-5)


def test_leaves_and_their_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(5)
    mass = rng.integers(0, 9, (CLASSES, maxent.LEAVES)) + 1 / maxent.LEAVES
    parts = factors(rng.normal(size=(FEATURES * ROWS + 4 * 512, CLASSES)).astype(np.float32))
    history = Tokens([b"a b c"]).rows[:, 2:3]
    kind, leaf = (a.ravel() for a in np.indices((CLASSES, maxent.LEAVES)))
    every = scorer(parts, defaults(mass))(np.repeat(history, len(kind), axis=1), kind, leaf)
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)
    hashes = np.array([0, 1 << 63, (1 << 64) - 1, 0xAB << 56], np.uint64)
    table = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "hash long")
    assert [r[0] for r in table.select(leaf_of("hash")).collect()] == maxent.leaves_of(hashes).tolist()


def test_weights_far_apart_do_not_lose_the_probabilities():
    weights = np.zeros((FEATURES * ROWS + 4 * 512, CLASSES), np.float32)
    t = Tokens([b"a b c"])
    for feature, own in enumerate(t.rows[:, 2]):
        weights[own] = -60.0
        weights[own, feature % 2] = 60.0
    found = scorer(factors(weights), defaults(np.ones((CLASSES, maxent.LEAVES))))(t.rows, t.classes, t.leaves)
    z = np.array([sum(float(weights[own, k]) for own in t.rows[:, 2]) for k in range(CLASSES)])
    of_class = z[t.classes[2]] - z.max() - math.log(np.exp(z - z.max()).sum())
    assert found[2] == pytest.approx(of_class - math.log(maxent.LEAVES), rel=1e-6)


def test_a_step_lowers_the_loss_of_every_factor():
    rng = np.random.default_rng(6)
    mass = np.ones((CLASSES, maxent.LEAVES))
    parts = factors(rng.normal(size=(FEATURES * ROWS + 4 * 512, CLASSES)).astype(np.float32))
    squares = factors(np.zeros((FEATURES * ROWS + 4 * 512, CLASSES), np.float32), "F")
    t = Tokens([b"one two three four one two", b"five"])
    for factor in range(maxent.LEVELS + 1):
        before = scorer(parts, defaults(mass))(t.rows, t.classes, t.leaves).sum()
        for own, *step in list(maxent.steps(parts, defaults(mass), t.rows, t.classes, t.leaves)):
            if own == factor:
                maxent.update(parts[own], squares[own], *step)
        assert scorer(parts, defaults(mass))(t.rows, t.classes, t.leaves).sum() > before


def test_rows_of_the_words_follow_the_training_texts():
    made = [maxent.word_rows(n) for n in (0, 1 << 20, 6 << 20, 25 << 20, 1 << 40)]
    assert made == [1 << 10, 1 << 10, 1 << 11, 1 << 13, 1 << 13]
