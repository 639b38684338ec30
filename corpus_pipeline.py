"""From raw documents to token ids: quality, near duplicates, repeated passages, benchmark leaks, encoding.

Every stage takes (spark, docs, sf_dir), ``docs`` with the columns of ``documents``, and works
on all rows it gets. All but the last return the same columns. A null text stays null where
its row stays; other columns go along unchanged, but for ``n_chars``, which follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.bpe import encode_documents
from kerbside.llm.common import read_table, written
from kerbside.llm.decontaminate import decontaminate
from kerbside.llm.quality import THRESHOLD, fit_classifier, score_column
from kerbside.llm.simhash import keep_one
from kerbside.llm.suffix_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    forest = fit_classifier(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(score_column(docs, forest) >= THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that also start elsewhere are cut out of the texts, with what is left of cut characters."""
    found = remove_repeats(docs, carry=True)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept_text")).alias("text")
    changed = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")}
    return found.select(*[changed.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate(docs, read_table(spark, sf_dir, "benchmark"), carry=True)
    return found.where(~F.col("contaminated")).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digests of the ids and of the decoded bytes."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_documents(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level bpe", encode),
]

#: Trained scores, fingerprints and ranks are beyond SQL; tests hold the stages against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written before the next reads them."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"stage{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
