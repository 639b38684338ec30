"""Sharding into near-equal bytes by a histogram sort.

Rows are ordered by a key: the text's hash, then the id's, so equal texts stand together, then a
hash of the row's place in the input, so that copies of one row can be parted. The
splitters between shards, and between the finer bins that tasks sort, are searched all at
once: each round counts the exact bytes and rows below a set of candidate keys, in every
partition and then summed, and narrows each splitter's bracket to the two candidates around
its target. It ends when every splitter is within tolerance, or no row is left inside its
bracket. The counts below the final splitters give each bin's first slot, so rows are
exchanged once, by bin, and numbered within bins. Carried rows are exchanged whole, and their
sizes and checksums are those of the texts that arrive.

A group of equal texts is cut by a shard's border only where keeping it whole would move the
border by more than ``SNAP`` of a shard.

The keys are found twice, to be counted and to be exchanged by, so input that is more than a scan
is written first.

Defined cases: a null text has size 1 and checksum 0; equal rows get slots of their own, in
any order among them; a null id sorts as any other; fewer rows than shards leave shards empty;
an empty table gives no rows; other columns are ignored unless carried. A text of any length moves
as one row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kerbside.llm.common import checkpointed, settled, text_chunks

SHARDS = 16
#: Share of a shard's bytes by which its borders may miss.
TOLERANCE = 0.0005
#: Share of a bin's bytes by which the borders inside a shard may miss.
BIN_TOLERANCE = 0.1
SNAP = 0.02
#: Candidate keys for each open splitter and round.
PROBES = 16
#: Bits of the key that order rows of one text, and those of them that part copies of one row.
ID_BITS = 27
COPY_BITS = 16
KEY_END = 1 << 63


def sized(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """doc_id, size, text_crc32 and the key, a long from 0 on."""
    text, doc_id = docs[text_col].cast("string"), docs[id_col]
    known = F.coalesce(text, F.lit("")).cast("binary")
    high = F.shiftleft(F.shiftrightunsigned(F.xxhash64(known), 1 + ID_BITS), ID_BITS)
    of_id = F.xxhash64(doc_id, F.lit(1)).bitwiseAND(F.lit((1 << ID_BITS) - (1 << COPY_BITS)))
    of_place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << COPY_BITS) - 1))
    columns = [
        doc_id.alias("doc_id"),
        (F.octet_length(known) + 1).cast("long").alias("size"),
        F.crc32(known).alias("text_crc32"),
        high.bitwiseOR(of_id).bitwiseOR(of_place).alias("key"),
    ]
    return docs.select(*columns, *([F.struct(*docs.columns).alias("row")] if carry else []))


def counts_below(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each of the sorted probes."""
    sent = keys.sparkSession.sparkContext.broadcast(probes)

    def run(batches):
        size, rows = np.zeros(len(sent.value) + 1, np.int64), np.zeros(len(sent.value) + 1, np.int64)
        for batch in batches:
            key, bytes_ = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            at = np.searchsorted(sent.value, key, side="right")
            np.add.at(size, at, bytes_)
            np.add.at(rows, at, 1)
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(size[some]), pa.array(rows[some])], names=["at", "size", "n"])

    counted = keys.select("key", "size").mapInArrow(run, "at long, size long, n long")
    found = counted.groupBy("at").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).toPandas()
    out = np.zeros((2, len(probes) + 1), np.int64)
    out[:, found["at"].to_numpy(np.int64)] = found[["size", "n"]].to_numpy(np.int64).T
    below = np.cumsum(out, axis=1)[:, :-1]
    sent.destroy()
    return below[0], below[1]


def splitters(keys: DataFrame, shards: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """``shards * bins - 1`` keys that part the rows, and the rows below each."""
    total, n_rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    parts = shards * bins
    target = np.array([total * i // parts for i in range(1, parts)], np.int64)
    border = np.arange(1, parts) % bins == 0
    slack = np.where(border, TOLERANCE * total / shards, BIN_TOLERANCE * total / parts)
    # Each bracket's ends: key, bytes below, rows below.
    low, high = np.zeros((3, parts - 1), object), np.zeros((3, parts - 1), object)
    high[0], high[1], high[2] = KEY_END - 1, total, n_rows
    while True:
        miss = np.minimum(np.abs(low[1] - target), np.abs(high[1] - target))
        open_ = np.flatnonzero((miss > slack) & (high[2] - low[2] > 1) & (high[0] - low[0] > 1))
        if not open_.size:
            break
        steps = [low[0][i] + (high[0][i] - low[0][i]) * j // (PROBES + 1) for i in open_ for j in range(1, PROBES + 1)]
        probes = np.unique(np.array(steps, np.int64))
        size, n = counts_below(keys, probes)
        for i in open_:
            at = int(np.searchsorted(size, target[i], side="right"))  # the first probe with more below it
            if at < len(probes) and probes[at] < high[0][i]:
                high[:, i] = int(probes[at]), int(size[at]), int(n[at])
            if at and probes[at - 1] > low[0][i]:
                low[:, i] = int(probes[at - 1]), int(size[at - 1]), int(n[at - 1])
    nearer = np.abs(low[1] - target) <= np.abs(high[1] - target)
    chosen = np.where(nearer, low[0], high[0]).astype(np.int64)
    # A shard's border moves to an end of the group of equal texts it cuts, if one is near.
    starts = chosen >> ID_BITS << ID_BITS
    ends = np.minimum(starts.astype(object) + (1 << ID_BITS), KEY_END - 1).astype(np.int64)
    probes = np.unique(np.concatenate([chosen, starts[border], ends[border]]))
    if total:
        size, _ = counts_below(keys, probes)
        below = lambda key: size[np.searchsorted(probes, key)]
        for i in np.flatnonzero(border):
            best = min((int(k) for k in (starts[i], ends[i])), key=lambda k: abs(int(below(k)) - int(target[i])))
            if abs(int(below(best)) - int(target[i])) <= max(SNAP * total / shards, abs(int(below(chosen[i])) - int(target[i]))):
                chosen[i] = best
    # A moved border may have passed borders of bins; those stay within their shard.
    edges = np.r_[0, np.maximum.accumulate(chosen[border]), KEY_END - 1]
    shard = np.arange(1, parts) // bins
    chosen = np.where(border, edges[shard], np.clip(chosen, edges[shard], edges[shard + 1]))
    chosen = np.maximum.accumulate(chosen)
    probes = np.unique(chosen)
    return chosen, counts_below(keys, probes)[1][np.searchsorted(probes, chosen)]


def arrived(rows: DataFrame, text_col: str) -> DataFrame:
    """The rows with size and text_crc32 of the text in ``row``, which thereby is needed whole."""

    def run(batches):
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pc.struct_field(batch.column("row"), text_col).cast(pa.string())], names=["text"])
            sizes, sums = [], []
            for _, _, data in text_chunks(texts):
                sizes += [len(t) + 1 for t in data]
                sums += [zlib.crc32(t) for t in data]
            made = {"size": pa.array(sizes, pa.int64()), "text_crc32": pa.array(sums, pa.int64())}
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([made.get(n, batch.column(n)) for n in names], names=names)

    return rows.mapInArrow(run, rows.schema)


def shard_by_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, carry: bool = False
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and, if ``carry``, the whole row as ``row``."""
    spark = docs.sparkSession
    rows = sized(settled(docs), id_col, text_col, carry)
    keys = checkpointed(rows.select("key", "size") if carry else rows)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bins = max(1, -(-4 * parts // shards))
    found, below = splitters(keys, shards, bins)
    starts = np.r_[0, below]
    # A bin's shard goes by its number; its first slot, by the rows between it and the shard's start.
    first = starts - starts[np.arange(shards * bins) // bins * bins]
    sent = spark.sparkContext.broadcast((found, first))

    def run(batches):
        for batch in batches:
            borders, slots = sent.value
            bin_ = np.searchsorted(borders, batch.column("key").to_numpy(zero_copy_only=False), side="right")
            names = [*batch.schema.names, "bin", "first"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bin_), pa.array(slots[bin_])], names=names)

    table = rows if carry else keys
    schema = StructType([*table.schema.fields, StructField("bin", LongType()), StructField("first", LongType())])
    binned = table.mapInArrow(run, schema)
    order = Window.partitionBy("bin").orderBy("key", "doc_id", "text_crc32", "size")
    numbered = binned.withColumn("place", F.row_number().over(order))
    return (arrived(numbered, text_col) if carry else numbered).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.expr(f"cast(bin div {bins} as int)").alias("shard"),
        (F.col("first") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *(["row"] if carry else []),
    )
