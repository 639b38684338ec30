"""Benchmark decontamination as a prefix-filtered set join.

Every window of ``size`` consecutive words of a benchmark item must occur whole, so the
containment threshold is 1 and one token per window is the necessary prefix: its rarest, by
the counts over all documents, made of the benchmark's words alone. Where a document has that token, the window can
only stand at one place (positional bound), which must lie within the document (length
bound); there the words are compared one by one.

The benchmark's windows are cut into blocks of a bounded number of rows. Each block is
broadcast, and each task holds one block's index at a time, so any benchmark size works with
one pass over the documents.

Defined cases: a null or empty text has no words; an item without words has no windows, one
with fewer than ``size`` words is one window; a null item id counts as the empty string; rows
with the same item id are one item; repeated document rows are judged each; empty tables give
no rows or no hits; other columns are ignored. A text longer than a part is a part of its own, held
whole with the numbers of its words.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbside.llm.common import by_chunk, checkpointed, ragged, text_bytes, two_columns, written
from kerbside.llm.words import split_words, word_counts

WINDOW_WORDS = 10
#: Windows and items in one broadcast block: some 30 MB.
BLOCK_ROWS = 200_000
#: Places compared at once.
COMPARED = 1 << 18


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct (window, item): the windows of each item, words joined by single spaces."""

    def run(batches):
        for batch in batches:
            for at, text in enumerate(text_bytes(batch)):
                words = split_words(text)
                if not words:
                    continue
                windows = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}
                column = pa.array(list(windows), pa.binary()).cast(pa.string())
                ids = pa.array([batch.column(0)[at].as_py()] * len(column), pa.string())
                yield pa.RecordBatch.from_arrays([column, ids], names=["window", "item"])

    rows = items.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return rows.mapInArrow(run, "window string, item string").distinct()


def with_prefix(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(window, item, at): ``at`` is the place of the window's rarest word."""
    words = windows.select("window").distinct().select("window", F.posexplode(F.split("window", " ")).alias("at", "word"))
    rarest = (
        words.join(counts, "word", "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("first"))
        .select("window", F.col("first.at").alias("at"))
    )
    return windows.join(rarest, "window")


class Block:
    """One block of windows, by the number of their prefix word."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        self.items = sorted({item for _, item, _ in rows})
        item_of = {item: i for i, item in enumerate(self.items)}
        self.words: dict[bytes, int] = {}
        windows: dict[str, int] = {}
        texts, at = [], []
        for window, _, place in rows:
            if window not in windows:
                windows[window] = len(windows)
                texts.append([self.words.setdefault(w, len(self.words)) for w in window.encode().split()])
                at.append(place)
        self.size = np.array([len(t) for t in texts], np.int64)
        width = int(self.size.max(initial=1))
        self.window = np.array([t + [-1] * (width - len(t)) for t in texts], np.int64).reshape(-1, width)
        self.at = np.array(at, np.int64)
        first = self.window[np.arange(len(texts)), self.at]
        self.order = np.argsort(first, kind="stable")
        edges = np.searchsorted(first[self.order], np.arange(len(self.words) + 1))
        self.begin, self.number = edges[:-1], np.diff(edges)
        pairs = np.array(sorted((windows[w], item_of[item]) for w, item, _ in rows), np.int64).reshape(-1, 2)
        edges = np.searchsorted(pairs[:, 0], np.arange(len(texts) + 1))
        self.item, self.item_begin, self.item_number = pairs[:, 1], edges[:-1], np.diff(edges)

    def find(self, flat: list[bytes], starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows that occur in the texts whose words are ``flat``: (window, place of its first word)."""
        ids = np.fromiter(map(self.words.get, flat, repeat(-1)), np.int64, len(flat))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        places = np.flatnonzero(ids >= 0)
        places = places[self.number[ids[places]] > 0]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        ends = np.cumsum(self.number[ids[places]])
        begin = 0
        while begin < len(places):  # bounded numbers of candidates, a place with more by itself
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + COMPARED)))
            some, begin = places[begin:end], end
            number = self.number[ids[some]]
            window = self.order[ragged(self.begin[ids[some]], number)]
            place = np.repeat(some, number)
            start, doc = place - self.at[window], owner[place]
            fits = (start >= starts[doc]) & (start + self.size[window] <= starts[doc] + sizes[doc])
            window, start = window[fits], start[fits]
            for column in range(self.window.shape[1]):
                inside = column < self.size[window]
                same = ~inside | (ids[np.minimum(start + column, len(ids) - 1)] == self.window[window, column])
                window, start = window[same], start[same]
            found.append((window, start))
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *(w for w, _ in found)]), np.concatenate([none, *(s for _, s in found)])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW_WORDS,
    carry: bool = False,
) -> DataFrame:
    """Per document: its words, those inside an occurrence of a benchmark window, and the items concerned.

    With ``carry``, the whole row of the input is in ``row``.
    """
    spark = docs.sparkSession
    rows = two_columns(docs, id_col, text_col, carry)
    carried = ("row",) if carry else ()
    windows = item_windows(two_columns(benchmark, item_col, item_text_col), size)
    # Written, so that Spark knows the size of what it may broadcast.
    words = written(windows.select(F.explode(F.split("window", " ")).alias("word")).distinct(), "words")
    indexed = checkpointed(with_prefix(windows, word_counts(rows, among=words)))
    n_blocks = max(1, -(-indexed.count() // BLOCK_ROWS))
    blocks = []
    for number in range(n_blocks):
        part = indexed.where(F.pmod(F.xxhash64("window", "item"), F.lit(n_blocks)) == number)
        blocks.append(spark.sparkContext.broadcast([tuple(r) for r in part.select("window", "item", "at").collect()]))

    def run(batches):
        held: dict[int, Block] = {}

        def index(number: int) -> Block:
            if number not in held:
                held.clear()
                held[number] = Block(blocks[number].value)
            return held[number]

        def work(texts):
            words = [split_words(text) for text in texts]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            starts = np.cumsum(sizes) - sizes
            flat = [w for ws in words for w in ws]
            edges = np.zeros(len(flat) + 1, np.int64)
            items: list[set[str]] = [set() for _ in texts]
            for number in range(len(blocks)):
                block = index(number)
                window, start = block.find(flat, starts, sizes)
                np.add.at(edges, start, 1)
                np.add.at(edges, start + block.size[window], -1)
                doc = np.searchsorted(starts + sizes, start, side="right")
                seen = np.unique(doc * len(block.at) + window) if len(doc) else doc
                for d, w in zip((seen // len(block.at)).tolist(), (seen % len(block.at)).tolist(), strict=True):
                    b = block.item_begin[w]
                    items[d].update(block.items[i] for i in block.item[b : b + block.item_number[w]])
            hit = np.cumsum(edges)[:-1] > 0
            n_hit = np.diff(np.r_[0, np.cumsum(hit)][np.r_[starts, len(flat)]]) if len(texts) else sizes
            lists = [sorted(found) for found in items]
            digests = [hashlib.sha256(",".join(found).encode()).hexdigest() for found in lists]
            n_items = np.fromiter(map(len, lists), np.int64, len(lists))
            longs = [pa.array(column) for column in (sizes, n_hit.astype(np.int64), n_items)]
            return [*longs, pa.array(digests), pa.array(n_hit > 0), pa.array(lists, pa.list_(pa.string()))]

        names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"]
        yield from by_chunk(work, names, carried)(batches)

    made = StructType.fromDDL(
        "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"
    )
    schema = StructType([rows.schema["doc_id"], *made.fields, *[rows.schema[c] for c in carried]])
    return rows.mapInArrow(run, schema)
