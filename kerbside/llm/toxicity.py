"""Toxicity by a factorization machine over hashed terms.

A term is a word, in small ASCII letters, or the first bytes of a longer word, so that
inflected and compound forms share a term. Terms are hashed into 2 ** ``BITS`` buckets. A
text's value in a bucket is log(1 + count), and a text's values have unit length, so a long
text weighs as much as a short one. A value is then multiplied by the bucket's weight: ``FLOOR``
plus the absolute logarithm of the ratio of the shares of both labels' rows that hold it
(``PRIOR`` rows are added to each side), 0 in fewer than ``LEAST_ROWS`` rows; so terms that
tell little are not learned by heart. The margin is

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

whose last sum is found from the sums of v_i x_i and of their squares, in time linear in the
terms. It lets two terms count together, as an insult with a mention of a group, where neither
counts by itself; no weights of single terms can do that.

The machine is fitted on the driver, by gradient steps with a step size per weight, on a
sample of at most ``SAMPLE_ROWS`` labelled rows outside the held-out fold, the smallest hashes
of the id first, one row of each id. The driver gets hashed terms, at most one number pair per
bucket and row, never texts. Every document is then scored in the task that reads it, in
parts of about 1 MB; nothing is shuffled, and what is broadcast has the fixed size of the weights.

Defined cases: a null or empty text has no terms and gets the bias's score; a null label or id
is not learned from; several labels of one id count as the smallest, of several texts of one
id the smallest; without labels of both classes the score is the share of label 1 (0 without
any); repeated rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import LOWER_WORDS, by_chunk, crc_mod, text_chunks, two_columns
from kerbside.llm.suffixes import BASE, Hashed, mixed, powers

BITS = 18
FACTORS = 4
#: Bytes of a word's beginnings that are terms too, if the word is longer.
BEGINNINGS = (5, 6, 7)
SAMPLE_ROWS = 8_000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
PRIOR = 5.0
FLOOR = 0.4
LEAST_ROWS = 3
EPOCHS = 12
BATCH_ROWS = 128
RATE = 1.0
DECAY = 1e-3


@dataclass
class Terms:
    """Texts as sparse rows: row i has the buckets and values from ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    buckets: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Terms:
        sizes = np.diff(self.starts)[rows]
        starts = np.r_[0, np.cumsum(sizes)]
        at = np.arange(starts[-1]) + np.repeat(self.starts[rows] - starts[:-1], sizes)
        return Terms(starts, self.buckets[at], self.values[at])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum over each row's terms of ``values``, one per term or one row per term."""
        total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
        return total[self.starts[1:]] - total[self.starts[:-1]]


def hashed_terms(texts: list[bytes], bits: int = BITS) -> Terms:
    data = b"\n".join([*texts, b""])
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    buffer = np.frombuffer(data.translate(LOWER_WORDS), np.uint8)
    space = np.r_[True, buffer == 0x20]
    edges = np.flatnonzero(space[1:] != space[:-1])  # every text ends in a separator
    start, end = edges[0::2], edges[1::2]
    owner = np.searchsorted(ends, start, side="right")
    prefix = Hashed(buffer).prefix
    back = powers(pow(BASE, -1, 1 << 64), len(buffer) + 1)[start]
    found = []
    for size in (None, *BEGINNINGS):
        long_enough = slice(None) if size is None else np.flatnonzero(end - start > size)
        first = start[long_enough]
        after = end[long_enough] if size is None else first + size
        h = (prefix[after] - prefix[first]) * back[long_enough]
        if size is not None:
            h += np.uint64(size)  # a word and an equal beginning of another differ
        found.append(owner[long_enough] << bits | (mixed(h) >> np.uint64(64 - bits)).astype(np.int64))
    keys, counts = np.unique(np.concatenate(found), return_counts=True)
    row, bucket = keys >> bits, keys & ((1 << bits) - 1)
    starts = np.searchsorted(row, np.arange(len(texts) + 1))
    terms = Terms(starts, bucket.astype(np.int32), np.log1p(counts))
    length = np.sqrt(terms.sums(terms.values**2))
    terms.values = (terms.values / length[row]).astype(np.float32)
    return terms


def term_weights(x: Terms, y: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The weight of every bucket; 0 in buckets that say nothing of the labels."""
    marked = np.repeat(y == 1, np.diff(x.starts))
    one, zero = (np.bincount(x.buckets[own], minlength=1 << bits) for own in (marked, ~marked))
    share = y.mean()
    ones, zeros = (one + PRIOR * share) / (len(y) * share), (zero + PRIOR * (1 - share)) / (len(y) * (1 - share))
    return np.where(one + zero >= LEAST_ROWS, FLOOR + np.abs(np.log(ones / zeros)), 0).astype(np.float32)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    linear: np.ndarray
    factors: np.ndarray

    def weighted(self, x: Terms) -> Terms:
        """The terms that have a weight, with their values multiplied by it."""
        weight = self.weights[x.buckets]
        kept = np.flatnonzero(weight)
        return Terms(np.searchsorted(kept, x.starts), x.buckets[kept], x.values[kept] * weight[kept])

    def margin(self, x: Terms) -> np.ndarray:
        return self.parts(self.weighted(x))[0]

    def parts(self, x: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of weighted terms: the margin of every row, v x of every term, and the sum of v x of every row."""
        vx = self.factors[x.buckets] * x.values[:, None]
        total = x.sums(vx)
        pairs = 0.5 * (total**2 - x.sums(vx * vx)).sum(axis=1)
        return self.bias + x.sums(self.linear[x.buckets] * x.values) + pairs, vx, total

    def score(self, x: Terms) -> np.ndarray:
        """Probability of label 1."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def train(x: Terms, y: np.ndarray, bits: int = BITS, factors: int = FACTORS, epochs: int = EPOCHS, rate: float = RATE) -> Machine:
    """The machine that fits labels ``y`` of rows ``x``; rows of label 1, if rarer, weigh more, up to four times."""
    rng, size = np.random.default_rng(11), 1 << bits
    share = float(y.mean()) if len(y) else 0.0
    if share in (0.0, 1.0):
        none = np.zeros(size, np.float32)
        return Machine(40.0 if share else -40.0, none, none, np.zeros((size, factors), np.float32))
    start = rng.normal(0, 0.01, (size, factors)).astype(np.float32)
    machine = Machine(np.log(share / (1 - share)), term_weights(x, y, bits), np.zeros(size, np.float32), start)
    x = machine.weighted(x)
    # Squares of past gradients begin at 1, so that a term's step grows with what it has to tell.
    past_linear, past_factors, past_bias = np.ones(size, np.float32), np.ones((size, factors), np.float32), 1.0
    weight = np.where(y == 1, min(4.0, max(1.0, (1 - share) / share)), 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), BATCH_ROWS):
            rows = order[begin : begin + BATCH_ROWS]
            part = x.take(rows)
            margin, vx, total = machine.parts(part)
            error = weight[rows] * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y[rows])
            owner = np.repeat(np.arange(len(rows)), np.diff(part.starts))
            scaled = error[owner] * part.values
            used, slot = np.unique(part.buckets, return_inverse=True)
            step = np.bincount(slot, scaled, len(used)).astype(np.float32) + DECAY * machine.linear[used]
            past_linear[used] += step * step
            machine.linear[used] -= rate * step / np.sqrt(past_linear[used])
            for f in range(factors):
                push = scaled * (total[owner, f] - vx[:, f])
                step = np.bincount(slot, push, len(used)).astype(np.float32) + DECAY * machine.factors[used, f]
                past_factors[used, f] += step * step
                machine.factors[used, f] -= rate * step / np.sqrt(past_factors[used, f])
            past_bias += error.sum() ** 2
            machine.bias -= rate * error.sum() / np.sqrt(past_bias)
    return machine


def labelled_terms(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = SAMPLE_ROWS, folds: int = FOLDS, held_out: int = HELD_OUT
) -> tuple[Terms, np.ndarray]:
    """Terms and labels of at most ``max_rows`` labelled documents outside the held-out fold; ``docs`` has doc_id and text."""
    known = (
        labels.select(labels["doc_id"].alias("doc_id"), labels[label].alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (crc_mod("doc_id", folds) != held_out))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def run(batches):
        for batch in batches:
            for begin, end, texts in text_chunks(batch):
                x = hashed_terms(texts)
                ids, marks = (batch.column(c).slice(begin, end - begin) for c in ("doc_id", "label"))
                starts = pa.array(x.starts, pa.int32())
                lists = [pa.ListArray.from_arrays(starts, pa.array(a)) for a in (x.buckets, x.values)]
                yield pa.RecordBatch.from_arrays([ids, marks.cast(pa.int32()), *lists], names=["doc_id", "label", "buckets", "values"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, label int, buckets array<int>, values array<float>").toArrow()
    found = found.sort_by("doc_id").combine_chunks()
    sizes = found.column("buckets").combine_chunks().value_lengths().to_numpy()
    flat = [found.column(c).combine_chunks().flatten().to_numpy() for c in ("buckets", "values")]
    return Terms(np.r_[0, np.cumsum(sizes)].astype(np.int64), *flat), found.column("label").to_numpy().astype(np.float64)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    max_rows: int = SAMPLE_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Each document's fold, score and prediction."""
    rows = two_columns(docs, id_col, text_col)
    machine = train(*labelled_terms(rows, labels, label, max_rows))
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(texts):
        return [pa.array(sent.value.score(hashed_terms(texts)))]

    scored = rows.mapInArrow(by_chunk(work, ["score"]), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
