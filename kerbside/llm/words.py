"""Counts of all words of a table, combined in each task before they are shuffled."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import LOWER_WORDS, text_bytes

#: Distinct words a task counts before it hands its counts on.
HELD_WORDS = 500_000


def split_words(text: bytes) -> list[bytes]:
    """Small ASCII letters, digits and everything beyond ASCII make words."""
    return text.translate(LOWER_WORDS).split()


def word_counts(rows: DataFrame, split: Callable[[bytes], list[bytes]] = split_words, among: DataFrame | None = None) -> DataFrame:
    """(word, n) over all texts of ``rows``, which has a text column ``text``; only of the words of ``among``, if given.

    Where Spark broadcasts ``among``, other words are dropped before the exchange.
    """

    def run(batches):
        counts: Counter = Counter()

        def out():
            words = pa.array(list(counts.keys()), pa.binary()).cast(pa.string())
            batch = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for text in text_bytes(batch):
                counts.update(split(text))
                if len(counts) > HELD_WORDS:
                    yield out()
        yield out()

    counted = rows.select("text").mapInArrow(run, "word string, n long")
    if among is not None:
        counted = counted.join(among, "word", "left_semi")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))
