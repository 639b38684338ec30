"""Shared helpers: input columns, scratch folder, words as bytes, bounded chunks of a batch."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Bytes that separate words made of letters and digits, and those that are white space.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: ASCII capitals become small, every other byte stays; UTF-8 keeps them apart.
LOWER = bytes(range(256)).lower()
#: As LOWER, and separators become spaces.
LOWER_WORDS = bytes(0x20 if b in SEPARATORS else b for b in LOWER)
#: Text handled at once inside a task.
CHUNK_BYTES = 1 << 20
#: Hashes of rows that a task keeps while it numbers copies.
COUNTED_ROWS = 1_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def two_columns(table: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """The id as doc_id and the text, and, if ``carry``, the whole row as ``row``; so other columns cannot clash.

    A null text is empty.
    """
    text = F.coalesce(table[text_col].cast("string"), F.lit(""))
    whole = [F.struct(*[table[c] for c in table.columns]).alias("row")] if carry else []
    return table.select(table[id_col].alias("doc_id"), text.alias("text"), *whole)


def use_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the folder the cluster names; a temporary one only where all runs on one machine."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if folder is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))


def checkpointed(df: DataFrame) -> DataFrame:
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet into the folder for checkpoints and read again."""
    use_checkpoints(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def aside(df: DataFrame, name: str, rows_at_once: int = 8) -> Iterator[DataFrame]:
    """As :func:`written`, compressed as far as it goes; the files are removed on leaving.

    The rows may be large: a session of their own hands them to Python ``rows_at_once`` at a time.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    try:
        reader = spark.newSession()
        reader.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_at_once))
        reader.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
        yield reader.read.schema(df.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settled(df: DataFrame) -> DataFrame:
    """The rows, in partitions and an order that stay the same when they are computed again.

    A scan, projected and filtered, has that already; the rows of any other plan are written first.
    """
    nodes, stable = [df._jdf.queryExecution().optimizedPlan()], {"Project", "Filter", "LogicalRelation", "LogicalRDD", "LocalRelation"}
    while nodes:
        node = nodes.pop()
        if node.nodeName() not in stable:
            return written(df, "rows")
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return df


def copy_numbers(rows: DataFrame, hash_col: str) -> DataFrame:
    """The rows and ``copy``: 0 for the first row of a hash in its partition, for each further one its own number.

    Which numbers a partition gives depends on its rows, not on their order. Repeated rows can so be
    dealt apart, and other rows' numbers are the same however the table is cut.
    """

    def run(batches):
        task, seen = TaskContext.get().partitionId() << 32, {}
        for batch in batches:
            numbers = []
            for own in batch.column(hash_col).to_pylist():
                before = seen.get(own, 0)
                seen[own] = before + 1
                numbers.append(before and task + before)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "copy"])
            if len(seen) > COUNTED_ROWS:
                seen.clear()  # numbers begin anew: a few copies more share one

    return rows.mapInArrow(trimmed(run), StructType([*rows.schema.fields, StructField("copy", LongType())]))


def crc_mod(id_col: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes."""
    return [b"" if t is None else t for t in batch.column(name).cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together hold about ``limit`` bytes; a longer text is one range."""
    begin, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, at
            begin, size = at, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def text_chunks(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, row after the last, texts) of parts of a batch that hold about ``limit`` bytes each."""
    column = batch.column("text").cast(pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield begin, end, [b"" if t is None else t for t in column.slice(begin, end - begin).to_pylist()]
        begin = end


def trimmed(run: Callable) -> Callable:
    """``run``, a function for mapInArrow, that hands freed memory back to the system when a task ends.

    Python workers live on between tasks and would keep it.
    """

    def trimming(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim is not None:
            trim(0)

    return trimming


def by_chunk(work: Callable, names: list[str], carried: tuple[str, ...] = ()) -> Callable:
    """A function for mapInArrow: the id, what ``work(texts)`` gives as further arrays of a chunk, and carried columns."""

    def run(batches):
        for batch in batches:
            for begin, end, texts in text_chunks(batch):
                same = [batch.column(c).slice(begin, end - begin) for c in ("doc_id", *carried)]
                yield pa.RecordBatch.from_arrays([same[0], *work(texts), *same[1:]], names=["doc_id", *names, *carried])

    return run


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + sizes[i] - 1, one range after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(sizes) - sizes
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, sizes)


def word_ids(texts: list[list[bytes]], known: dict[bytes, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts in turn, equal words alike, and the words in each text."""
    known = {} if known is None else known
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = list(chain.from_iterable(texts))
    new = [word for word in dict.fromkeys(flat) if word not in known] if known else dict.fromkeys(flat)
    known.update(zip(new, count(len(known)), strict=False))
    return np.fromiter(map(known.__getitem__, flat), np.int64, len(flat)), sizes
