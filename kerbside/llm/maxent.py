"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). A word's class is a hash of its
last two bytes. The first factor is a softmax over ``CLASSES`` of weights summed over hashed features
of the history: the last word, the word before it (a skip), both together, and both their
classes. The second is a maximum-entropy model of the words of a class: proportional to the
word's count and one times the exponential of its weights, summed over features of the
history and the word. The history's part is the last word, and both words together; the word's is its
leaf, ``LEVELS`` digits of its hash, and features are hashed into rows whose number follows the training texts up to
``MOST_WORD_ROWS``. All words of a class are summed over, by factoring the class as the
vocabulary is: a softmax over the first digit, one over the second given the first, each with the
counts of all words below as its default, and the word's share among the counts of its leaf. So
without weights the factor is the word's share among the counts of its class. A class has one
place for unseen words, spread evenly over its leaves.

Counts cover all training texts. The weights of both factors are trained in rounds. One in
``MEASURED`` training texts is kept to measure the loss; the others are dealt by a hash into
blocks of some ``BLOCK_BYTES``, ordered by the hash, once: their features are written to the
shared folder and removed after training. In each round every block starts from the
current weights and step sizes, makes its own gradient updates, batch by batch, and the results
are averaged by tokens, in a tree of sums. Rounds end when one lowers the loss of both factors by less than
``SETTLED`` of it, or after ``ROUNDS``; a last one goes over the texts kept for measuring. So
what is learned depends on the texts alone, but for the order of sums, not on the partitions.

The counts are never broadcast. Texts are scored in blocks of some ``BLOCK_BYTES``, cut from the
rows of each partition in turn. A block hands on its distinct words with their counts in its own
training texts; one exchange by word sums them, and the sums go back to the blocks by the words'
hashes, written to the shared folder. So words are exchanged once, to be counted and looked up.
Within a block, words with equal 64-bit hashes are taken as equal. A word that a block did not ask
for fails the job. Cutting needs rows that come in the same order twice, so input that is more than a
scan is written first. In training, a repeated row goes to a block of its own number, from its
second copy in a partition on; so neither blocks nor groups grow with the copies of a row.

Defined cases: a null or empty text is its end token alone; a null id counts as empty text
in the fold's crc32; repeated rows are scored each; without training texts all words are
unseen and the weights are 0; an empty table gives no rows; other columns are ignored. A text
longer than a part is a part of its own, held whole with an entry per token. Of equal hashes of
rows any order among them gives the same sums, as such rows are equal texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kerbside.llm.common import aside, copy_numbers, crc_mod, settled, text_chunks, trimmed, two_columns, written
from kerbside.llm.suffixes import BASE, mixed, powers
from kerbside.llm.words import HELD_WORDS

FOLDS, HELD_OUT = 7, 2
#: No text holds it as a word.
END = b"\n"
CLASSES = 16
#: Hashed values of each feature, a power of two; there are four features.
ROWS = 4096
FEATURES = 4
#: Digits of a word's hash that make its leaf; a digit has as many values as there are classes.
LEVELS = 2
DIGIT = CLASSES.bit_length() - 1
LEAVES = CLASSES**LEVELS
LEAF = np.min_scalar_type(LEAVES - 1)
#: Features of the history that the words of a class are weighed by: the last word, and both together.
WORD_FEATURES = (0, 2)
#: Rows of each of them in each level, powers of two: as many as fit training texts of ``BYTES_A_ROW`` times that size.
LEAST_WORD_ROWS, MOST_WORD_ROWS = 1 << 10, 1 << 13
BYTES_A_ROW = 1 << 12
#: Rounds at most; the loss ends them.
ROUNDS = 20
SETTLED = 0.01
MEASURED = 16
RATE = 0.05
BATCH_TOKENS = 8192
#: Tokens scored at once.
SCORED = 1 << 14
BLOCK_BYTES = 8 << 20
#: Text whose tokens are found at once.
TOKEN_BYTES = 1 << 20

#: Hash of an end token, and words hashed at once.
END_HASH = np.uint64(3)
HASHED_WORDS = 1 << 16

_BYTES = np.random.default_rng(201).integers(0, 1 << 64, 256, dtype=np.uint64)
_IS_WHITE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def tokens_of(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def word_class(word: bytes) -> int:
    return int(_classes(np.array([int.from_bytes(word[-2:], "big")], np.uint64))[0])


def class_of(word: Column) -> Column:
    """As :func:`word_class`, of a binary column."""
    last_two = F.conv(F.hex(F.substring(word, -2, 2)), 16, 10).cast("long")
    return F.shiftright(last_two * F.lit(0x9E3779B1), 16).bitwiseAND(F.lit(CLASSES - 1))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)


def word_hashes(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words from start to end in a buffer; the same wherever a word stands."""
    usual = TOKEN_BYTES + TOKEN_BYTES // 8  # most buffers are no longer, so a worker finds their powers once
    up, down = _powers(usual) if len(buffer) < usual else _powers.__wrapped__(len(buffer) + 1)
    prefix = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTES[buffer] * up[: len(buffer)], out=prefix[1:])
    return mixed((prefix[end] - prefix[start]) * down[start])


def hashes_of(words: list[bytes]) -> np.ndarray:
    """The hashes that :class:`Tokens` has of these words, as longs; ``END`` is an end token."""
    made = np.empty(len(words), np.uint64)
    for begin in range(0, len(words), HASHED_WORDS):
        some = words[begin : begin + HASHED_WORDS]
        end = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
        buffer = np.frombuffer(b"".join(some), np.uint8)
        own = word_hashes(buffer, np.r_[0, end[:-1]], end)
        own[buffer[end - 1] == END[0]] = END_HASH
        made[begin : begin + HASHED_WORDS] = own
    return made.view(np.int64)


def _classes(last_two: np.ndarray) -> np.ndarray:
    """Classes of words by the number that their last two bytes make."""
    return (last_two * np.uint64(0x9E3779B1) >> np.uint64(16) & np.uint64(CLASSES - 1)).astype(np.int64)


def leaves_of(hashes: np.ndarray) -> np.ndarray:
    """The leaves of words by their hashes."""
    return (hashes >> np.uint64(64 - LEVELS * DIGIT)).astype(np.int64)


def leaf_of(hashes: Column | str) -> Column:
    """As :func:`leaves_of`, of a column of longs."""
    return F.shiftrightunsigned(hashes, 64 - LEVELS * DIGIT)


class Tokens:
    """The tokens of some texts in turn: each one's place, hash, class, leaf and features."""

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join([*texts, b""]).lower()
        buffer = np.frombuffer(self.data, np.uint8)
        white = _IS_WHITE[np.r_[np.uint8(32), buffer]]
        edges = np.flatnonzero(white[1:] != white[:-1])  # every text ends in white space
        start, end = edges[0::2], edges[1::2]
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        words = np.diff(np.r_[0, np.searchsorted(start, text_ends)])
        self.sizes = words + 1
        n, last = int(self.sizes.sum()), np.cumsum(self.sizes) - 1
        at = np.arange(len(start)) + np.repeat(np.arange(len(texts)), words)
        self.start, self.end = np.zeros(n, np.int64), np.zeros(n, np.int64)  # an end token has no place
        self.start[at], self.end[at] = start, end
        hashes = np.full(n, END_HASH)
        hashes[at] = word_hashes(buffer, start, end)
        self.hashes = hashes
        tail = np.full(n, np.uint64(END[0]))
        tail[at] = buffer[end - 1]
        tail[at] += np.where(end - start > 1, buffer[np.maximum(end - 2, 0)].astype(np.uint64) << np.uint64(8), np.uint64(0))
        self.classes = _classes(tail)
        self.leaves = leaves_of(hashes)

        first = last - words
        one, kind = np.r_[np.uint64(0), hashes][:n], np.r_[0, self.classes][:n]
        one[first], kind[first] = 1, 0
        two, kind_two = np.r_[np.uint64(1), one][:n], np.r_[0, kind][:n]
        two[first], kind_two[first] = 1, 0
        second = (first + 1)[words > 0]
        two[second], kind_two[second] = 2, 0
        factors = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
        shift = np.uint64(64 - ROWS.bit_length() + 1)
        rows = [one * factors[0] >> shift, two * factors[1] >> shift, (one * factors[2] ^ two * factors[1]) * factors[0] >> shift]
        rows.append((kind * CLASSES + kind_two).astype(np.uint64))
        self.rows = np.stack([r.astype(np.int64) + i * ROWS for i, r in enumerate(rows)])

    def distinct(self) -> tuple[list[bytes], np.ndarray]:
        """The distinct words, and each token's number among them."""
        _, first, number = np.unique(self.hashes, return_index=True, return_inverse=True)
        places = zip(self.start[first].tolist(), self.end[first].tolist(), strict=True)
        return [self.data[b:e] or END for b, e in places], number


def _exponentials(weights: np.ndarray, rows: np.ndarray, default: np.ndarray | None = None, nodes: np.ndarray | None = None):
    """The sums of the weights less their largest, and their exponentials: one row per class, one column per token.

    ``default``, if given, has a row for each node, and is added by each token's node.
    """
    if default is None:
        z, rows = weights.take(rows[0], axis=0), rows[1:]
    else:
        z = default.take(nodes, axis=0)
    for more in rows:
        z += weights.take(more, axis=0)
    z = np.ascontiguousarray(z.T)
    z -= z.max(axis=0)
    return z, np.exp(z)


def class_log_probabilities(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Natural logarithms of P(class | history), one row per token."""
    z, e = _exponentials(weights, rows)
    return (z - np.log(e.sum(axis=0))).T


def update(
    weights: np.ndarray,
    squares: np.ndarray,
    rows: np.ndarray,
    classes: np.ndarray,
    default: np.ndarray | None = None,
    nodes: np.ndarray | None = None,
) -> None:
    """One gradient step on a batch of tokens, with a step size per weight by its past gradients."""
    _, grad = _exponentials(weights, rows, default, nodes)
    grad /= grad.sum(axis=0)
    grad[classes, np.arange(len(classes))] -= 1
    used = int(rows.max()) + 1  # the last feature may have few values
    every, shared = rows.ravel(), np.empty(rows.shape, np.float32)
    slopes = np.zeros((CLASSES, used), np.float32)
    for slope, own in zip(slopes, grad, strict=True):
        shared[:] = own
        np.add.at(slope, every, shared.ravel())
    past = squares.T[:, :used]  # fast if the squares are kept in Fortran's order, and the weights row by row
    scratch = slopes * slopes
    past += scratch
    np.sqrt(np.add(past, 1e-6, out=scratch), out=scratch)
    slopes *= RATE
    slopes /= scratch
    weights[:used] -= slopes.T


def word_rows(n_bytes: int) -> int:
    """Rows of a feature of the words, in each level, for ``n_bytes`` of training texts."""
    return min(max(1 << (n_bytes // BYTES_A_ROW).bit_length(), LEAST_WORD_ROWS), MOST_WORD_ROWS)


def factors(weights: np.ndarray, order: str = "C") -> list[np.ndarray]:
    """The weights of the classes and of each level of the words, which stand one below the other, as arrays of their own."""
    return [np.array(part, order=order) for part in (weights[: FEATURES * ROWS], *np.split(weights[FEATURES * ROWS :], LEVELS))]


def defaults(mass: np.ndarray) -> list[np.ndarray]:
    """For each level, logarithms of the counts below each digit, one row for each node; ``mass`` has the counts of all leaves."""
    return [np.log(mass.reshape(CLASSES ** (level + 1), CLASSES, -1).sum(axis=2)).astype(np.float32) for level in range(LEVELS)]


def steps(parts: list[np.ndarray], default: list[np.ndarray], rows: np.ndarray, classes: np.ndarray, leaves: np.ndarray) -> Iterator[tuple]:
    """The softmaxes that choose these tokens, the class's first: (factor, rows, choice, default, nodes)."""
    yield 0, rows, classes, None, None
    seen = [(rows[i] - i * ROWS).astype(np.uint32) for i in WORD_FEATURES]
    for level in range(LEVELS):
        nodes = classes << DIGIT * level | leaves >> DIGIT * (LEVELS - level)
        n = len(parts[level + 1]) // len(WORD_FEATURES)
        own = np.empty((len(seen) if n else 0, len(nodes)), np.int64)
        for i in range(len(own)):
            key = (seen[i] << np.uint32(DIGIT * (level + 1)) | nodes.astype(np.uint32)) * np.uint32(0x9E3779B1)
            own[i] = (key >> np.uint32(33 - n.bit_length())) + np.int64(i * n)
        yield level + 1, own, leaves >> DIGIT * (LEVELS - 1 - level) & CLASSES - 1, default[level], nodes


def scorer(parts: list[np.ndarray], default: list[np.ndarray]) -> Callable:
    """A function that gives, for rows, classes and leaves of some tokens, natural logarithms of P(class and leaf | history).

    Exponentials are taken of the weights once, and multiplied for each token.
    """

    def table(logs):
        logs = logs - logs.max(axis=1, keepdims=True)  # no choice of a row gets likelier by that
        return logs, np.exp(logs)

    weights, usual, ones = [table(part) for part in parts], [None, *map(table, default)], np.ones(CLASSES, np.float32)

    def run(rows: np.ndarray, classes: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        total, every = np.zeros(len(classes)), np.arange(len(classes)) * CLASSES
        for factor, own, choice, _, nodes in steps(parts, default, rows, classes, leaves):
            terms = [(*weights[factor], at) for at in own] + ([] if nodes is None else [(*usual[factor], nodes)])
            product = None
            for _, powers_of, at in terms:
                more = powers_of.take(at, axis=0)
                product = more if product is None else np.multiply(product, more, out=product)
            share = product.ravel().take(every + choice)
            few = np.flatnonzero(share < 1e-30)  # the product has run out of digits
            share[few] = 1
            sums = product @ ones
            sums[few] = 1
            total += np.log(share / sums)
            if len(few):
                z = sum(logs[at[few]].astype(np.float64) for logs, _, at in terms)
                most = z.max(axis=1)
                total[few] += z[np.arange(len(few)), choice[few]] - most - np.log(np.exp(z - most[:, None]).sum(axis=1))
        return total

    return run


def block_chunks(batches) -> Iterator[tuple[bool, int, list[bytes]]]:
    """(kept, block, texts) of parts of some ``TOKEN_BYTES`` of the blocks in turn, wherever the batches are cut."""
    owner, held, size = None, [], 0
    for batch in batches:
        for begin, end, texts in text_chunks(batch, TOKEN_BYTES):
            of = (batch.column(name).slice(begin, end - begin).to_pylist() for name in ("kept", "block"))
            for *own, text in zip(*of, texts, strict=True):
                if held and (own != owner or size + len(text) > TOKEN_BYTES):
                    yield *owner, held
                    held, size = [], 0
                owner = own
                held.append(text)
                size += len(text) + 1
    if held:
        yield *owner, held


def featurize(batches):
    """Each part's features and classes, so that no round has to find them again."""
    for kept, block, texts in block_chunks(batches):
        tokens = Tokens(texts)
        columns = [pa.array([kept]), pa.array([block], pa.int64())]
        made = tokens.rows.astype(np.uint16), tokens.classes.astype(np.uint8), tokens.leaves.astype(LEAF)
        columns += [pa.array([a.tobytes()], pa.binary()) for a in made]
        yield pa.RecordBatch.from_arrays(columns, names=["kept", "block", "rows", "classes", "leaves"])


def featurized(batches, leaves: bool = False) -> Iterator[tuple]:
    """(block, features, classes) of the parts that :func:`featurize` made, and, if asked for, the leaves."""
    for batch in batches:
        for i, block in enumerate(batch.column("block").to_pylist()):
            classes = np.frombuffer(batch.column("classes")[i].as_buffer(), np.uint8).astype(np.int64)
            rows = np.frombuffer(batch.column("rows")[i].as_buffer(), np.uint16).reshape(FEATURES, -1)
            more = [np.frombuffer(batch.column("leaves")[i].as_buffer(), LEAF).astype(np.int64)] if leaves else []
            yield block, rows.astype(np.int64), classes, *more


def train_round(dealt: DataFrame, weights: np.ndarray, squares: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The averages, by tokens, of the weights and squares that every block gets from its own texts.

    ``dealt`` has the columns block, rows, classes and leaves; a block's parts stand together in one partition.
    """
    spark = dealt.sparkSession
    sent = spark.sparkContext.broadcast((weights, squares, defaults(mass)))
    size = 2 * weights.size

    def learn(batches):
        total, n = np.zeros(size), 0
        *before, default = sent.value
        for _, parts in groupby(featurized(batches, leaves=True), key=lambda part: part[0]):
            own, past, seen = factors(before[0]), factors(before[1], "F"), 0
            for _, rows, classes, leaves in parts:
                for at in range(0, len(classes), BATCH_TOKENS):
                    s = slice(at, at + BATCH_TOKENS)
                    for factor, *step in steps(own, default, rows[:, s], classes[s], leaves[s]):
                        update(own[factor], past[factor], *step)
                seen += len(classes)
            total[: size // 2] += np.concatenate(own).ravel() * np.float64(seen)
            total[size // 2 :] += np.concatenate(past).ravel() * np.float64(seen)
            n += seen
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                names=["task", "n", "total"],
            )

    def add(batches):
        total, n = np.zeros(size), 0
        for batch in batches:
            for value in batch.column("total").to_pylist():
                total += np.frombuffer(value)
            n += sum(batch.column("n").to_pylist())
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["task", "n", "total"]
            )

    schema = "task long, n long, total binary"
    learned = dealt.mapInArrow(trimmed(learn), schema)
    sums = max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    summed = learned.repartition(sums, "task").mapInArrow(add, schema)
    total, n = np.zeros(size), 0
    for row in summed.toLocalIterator():  # at most ``sums`` rows of a fixed size, one at a time
        total += np.frombuffer(row["total"])
        n += row["n"]
    sent.destroy()
    if not n:
        return weights, squares
    own, past = ((part / n).astype(np.float32).reshape(weights.shape) for part in np.split(total, 2))
    return own, past


def mean_loss(dealt: DataFrame, weights: np.ndarray, mass: np.ndarray) -> float:
    """The mean over all tokens of -ln P(class and leaf | history); 0 without texts."""
    sent = dealt.sparkSession.sparkContext.broadcast((weights, defaults(mass)))

    def measure(batches):
        loss, n = 0.0, 0
        weights, default = sent.value
        log_probabilities = scorer(factors(weights), default)
        for _, rows, classes, leaves in featurized(batches, leaves=True):
            for at in range(0, len(classes), SCORED):
                s = slice(at, at + SCORED)
                loss -= float(log_probabilities(rows[:, s], classes[s], leaves[s]).sum())
            n += len(classes)
        yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([n], pa.int64())], names=["loss", "n"])

    loss, n = dealt.mapInArrow(trimmed(measure), "loss double, n long").agg(F.sum("loss"), F.sum("n")).first()
    sent.destroy()
    return loss / n if n else 0.0


def train(rows: DataFrame, n_bytes: int, rounds: int, mass: np.ndarray) -> np.ndarray:
    """The weights when the loss has settled: those of the classes, then those of each level of the words.

    ``rows`` holds the training texts, of ``n_bytes`` in all; ``mass`` the counts of each class's leaves.
    """
    n_rows = FEATURES * ROWS + LEVELS * len(WORD_FEATURES) * word_rows(n_bytes)
    weights = np.zeros((n_rows, CLASSES), np.float32)
    squares = np.zeros_like(weights)
    n_blocks = max(1, -(-n_bytes // BLOCK_BYTES))
    # Other bits of the hash than those that number the blocks.
    own = F.col("place")
    copy = F.when(F.col("copy") > 0, F.xxhash64("place", "copy")).otherwise(own)
    kept = F.pmod(F.xxhash64(own, F.lit("measured")), F.lit(MEASURED)) == 0

    # Dealt once, and written with the features found: the rounds read them and exchange nothing.
    # Some four blocks to a file, so that a file is one row group and no block is read in two parts.
    placed = copy_numbers(rows.select("text", F.xxhash64("doc_id", "text").alias("place")), "place")
    keyed = placed.select("text", kept.alias("kept"), F.pmod(copy, F.lit(n_blocks)).alias("block"), "place")
    placed = keyed.repartition(-(-n_blocks // 4), "block").sortWithinPartitions("kept", "block", "place")
    features = placed.select("text", "kept", "block").mapInArrow(trimmed(featurize), "kept boolean, block long, rows binary, classes binary, leaves binary")
    with aside(features, "features", rows_at_once=2) as dealt:
        learned, measured = (dealt.where(which).drop("kept") for which in (~F.col("kept"), F.col("kept")))
        loss = math.inf
        for _ in range(rounds):
            weights, squares = train_round(learned, weights, squares, mass)
            before, loss = loss, mean_loss(measured, weights, mass)
            if not loss or before < math.inf and before - loss < SETTLED * before:
                break
        return train_round(measured, weights, squares, mass)[0]


def cutting(block_bytes: int) -> Callable:
    """A function for mapInArrow that adds ``block``, as :func:`in_blocks` does."""

    def run(batches):
        first, begun = TaskContext.get().partitionId() << 31, 0
        for batch in batches:
            sizes = pc.add(pc.fill_null(pc.binary_length(batch.column("text").cast(pa.binary())), 0).cast(pa.int64()), 1)
            ends = begun + np.cumsum(sizes.to_numpy(zero_copy_only=False))
            block = pa.array(first + np.r_[begun, ends][:-1] // block_bytes)
            begun = int(ends[-1]) if len(ends) else begun
            yield pa.RecordBatch.from_arrays([*batch.columns, block], names=[*batch.schema.names, "block"])

    return run


def in_blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """The rows, which have a text, and ``block``: the rows of each partition in turn, some ``block_bytes`` to a block."""
    return rows.mapInArrow(trimmed(cutting(block_bytes)), StructType([*rows.schema.fields, StructField("block", LongType())]))


def vocabulary(batches):
    """The distinct words of each block in turn, their hashes, and their counts in its training texts; a word may come twice."""
    block, counts, heard = None, Counter(), set()

    def out():
        words = [*counts, *(heard - counts.keys())]
        n = np.zeros(len(words), np.int64)
        n[: len(counts)] = np.fromiter(counts.values(), np.int64, len(counts))
        columns = [pa.array(np.full(len(words), block)), pa.array(words, pa.binary()), pa.array(hashes_of(words)), pa.array(n)]
        counts.clear()
        heard.clear()
        return pa.RecordBatch.from_arrays(columns, names=["block", "word", "hash", "n"])

    for batch in batches:
        for begin, end, texts in text_chunks(batch, TOKEN_BYTES):
            blocks, learned = (batch.column(name).slice(begin, end - begin).to_pylist() for name in ("block", "learned"))
            for own, learns, text in zip(blocks, learned, texts, strict=True):
                if (counts or heard) and (own != block or len(counts) + len(heard) > HELD_WORDS):
                    yield out()
                block = own
                (counts if learns else heard).update(tokens_of(text))
    if counts or heard:
        yield out()


def block_counts(rows: DataFrame, block_bytes: int) -> DataFrame:
    """(block, hash, n, class): the counts over all training texts of the words of each block that :func:`in_blocks` cuts.

    ``class`` is null but in one row of each word.
    """
    cut = cutting(block_bytes)  # in the same worker, so that texts go to Python once
    asked = rows.select("text", "learned").mapInArrow(trimmed(lambda batches: vocabulary(cut(batches))), "block long, word binary, hash long, n long")
    of_word = Window.partitionBy("word").orderBy("block")
    whole = of_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = asked.select("block", "word", "hash", F.sum("n").over(whole).alias("n"), F.row_number().over(of_word).alias("turn"))
    return counted.select("block", "hash", "n", F.when(F.col("turn") == 1, class_of(F.col("word"))).alias("class"))


def look_up(known: np.ndarray, n: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The counts of the tokens with these hashes, by the sorted hashes of the known words."""
    distinct, number = np.unique(hashes, return_inverse=True)
    at = np.minimum(np.searchsorted(known, distinct), len(known) - 1)
    if not (known[at] == distinct).all():
        raise ValueError("a block holds words that it did not ask for: the rows came in another order")
    return n[at][number]


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT, rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row."""
    spark = docs.sparkSession
    rows = settled(two_columns(docs, id_col, text_col))
    learned = crc_mod("doc_id", folds) != held_out
    size = F.octet_length("text").cast("long")
    n_bytes = rows.agg(F.coalesce(F.sum(F.when(learned, size)), F.lit(0))).first()[0]

    answers = written(block_counts(rows.withColumn("learned", learned), BLOCK_BYTES), "counts")
    counted = answers.where(F.col("class").isNotNull() & (F.col("n") > 0)).groupBy("class", leaf_of("hash").alias("leaf"))
    n, v = np.zeros((CLASSES, LEAVES), np.int64), np.zeros((CLASSES, LEAVES), np.int64)
    for k, leaf, tokens, words in counted.agg(F.sum("n"), F.count("*")).collect():  # at most ``CLASSES * LEAVES`` rows
        n[k, leaf], v[k, leaf] = tokens, words
    # Tokens and words of each leaf and its part of the class's place for unseen words; log10 of that, and of all.
    mass = n + v + 1.0 / LEAVES
    in_leaf = np.log10(mass)
    in_all = math.log10(int(n.sum() + v.sum()) + 1)
    model = spark.sparkContext.broadcast((train(rows.where(learned), n_bytes, rounds, mass), defaults(mass)))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        weights, default = model.value
        log_probabilities = scorer(factors(weights), default)
        hashes = known.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        hashes, n_of = hashes[order], known.column("n").to_numpy()[order]
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for batch in texts.select(["text"]).to_batches():
            for _, _, data in text_chunks(batch, TOKEN_BYTES):
                t = Tokens(data)
                c = look_up(hashes, n_of, t.hashes)
                own = np.empty(len(c))
                for at in range(0, len(c), SCORED):
                    s = slice(at, at + SCORED)
                    own[s] = log_probabilities(t.rows[:, s], t.classes[s], t.leaves[s])
                first = np.cumsum(t.sizes) - t.sizes
                plain = np.log10(c + 1.0)
                columns[0].append(t.sizes)
                columns[1].append(np.add.reduceat((c > 0).astype(np.int64), first))
                columns[2].append(np.add.reduceat(plain, first) - t.sizes * in_all)
                columns[3].append(np.add.reduceat(own / math.log(10) + plain - in_leaf[t.classes, t.leaves], first))
        arrays = [np.concatenate(c) if c else np.zeros(0) for c in columns]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        made = [pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)]
        return pa.table([texts.column("doc_id"), *made], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    scored = (
        in_blocks(rows, BLOCK_BYTES)
        .groupBy("block")
        .cogroup(answers.select("block", "hash", "n").groupBy("block"))
        .applyInArrow(score, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    )
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", folds) == held_out).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(n.sum())).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
