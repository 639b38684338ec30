"""Quality: a classifier and a set of rules, both boosted trees over document statistics.

The trees are fitted on the driver on a bounded sample of labelled rows, at most ``max_rows``
of those whose crc32 of the id modulo 5 is not 0, the smallest hashes of the id first.
Every document is then scored in the task that reads it; nothing is shuffled.

Defined cases: a null text is an empty one and gets a score like any other; a null label or id
is not learned from; several labels of one id count as the smallest; without labels of both
classes the score is the share of label 1 (0.5 without any); repeated rows are scored each;
an empty table gives no rows; other columns of the input are ignored. A text longer than 1 MB
is held whole, with a few numbers per word. Of splits with equal gains the first feature and bin counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import by_chunk, crc_mod, text_chunks, two_columns
from kerbside.llm.statistics import DIRECTIONS, FEATURES, features, statistics
from kerbside.llm.trees import Forest, train

SAMPLE_ROWS = 20_000
HELD_OUT_OF = 5
THRESHOLD = 0.3


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled documents outside the held-out fold.

    Of rows with one id, the one with the smallest text counts, so an id's rows never come to the driver together.
    """
    known = (
        labels.select(labels["doc_id"].alias("doc_id"), labels[label].alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (crc_mod("doc_id", HELD_OUT_OF) != 0))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def run(batches):
        for batch in batches:
            for begin, end, texts in text_chunks(batch):
                x = features(statistics(texts))
                ids, marks = (batch.column(i).slice(begin, end - begin) for i in (0, 2))
                x = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([ids, marks.cast(pa.int32()), x], names=["doc_id", "label", "x"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, label int, x array<double>").toPandas()
    found = found.sort_values("doc_id", kind="stable")
    x = np.array(found["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return x, found["label"].to_numpy(np.float64)


def fit_classifier(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = SAMPLE_ROWS) -> Forest:
    """The quality classifier: deeper trees, no constraints."""
    return train(*labelled_sample(docs, labels, label, max_rows), trees=80, depth=5)


def fit_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = SAMPLE_ROWS) -> Forest:
    """The quality rules: more symbols, marks, capitals or repeats never raise the score."""
    return train(*labelled_sample(docs, labels, label, max_rows), directions=DIRECTIONS, trees=60, depth=4)


def score_column(docs: DataFrame, forest: Forest, text_col: str = "text") -> Column:
    """The score of each text as a column, for filters that keep all columns of their rows."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [sent.value.score(features(statistics(chunk))) for _, _, chunk in text_chunks(batch)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return score(docs[text_col].cast("string"))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Each document's fold, score and prediction."""
    rows = two_columns(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(fit_classifier(rows, labels))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(texts):
        return [pa.array(sent.value.score(features(statistics(texts))))]

    scored = rows.mapInArrow(by_chunk(work, ["score"]), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", HELD_OUT_OF) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def apply_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Each document's counts, whether the base rules fail it, the trees' score, and the verdict."""
    rows = two_columns(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(fit_rules(rows, labels))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = {"n_words": "words", "word_chars": "word_chars", "n_symbols": "symbols", "n_dup_lines": "dup_lines", "n_repeat_words": "repeat_words"}

    def work(texts):
        stats = statistics(texts)
        longs = [np.asarray(stats[name]).astype(np.int64) for name in counts.values()]
        failed = (longs[0] < 20) | (100 * longs[4] > 30 * longs[0])
        score = sent.value.score(features(stats))
        return [*map(pa.array, longs), pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))]

    names = [*counts, "base_failed", "score", "kept"]
    longs = ", ".join(f"{name} long" for name in counts)
    return rows.mapInArrow(by_chunk(work, names), f"doc_id {kind}, {longs}, base_failed boolean, score double, kept boolean")
