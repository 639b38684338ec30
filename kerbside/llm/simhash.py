"""SimHash near-duplicates by segment popcounts.

A fingerprint is embedded as the popcounts of its segments (``SEGMENT`` bits each). Two
fingerprints that differ in k bits are at most k apart in Manhattan distance there, so the
distance is a lower bound. The segments form ``groups``; within k bits, at least one group is
within k // groups. Each group is a grid: a fingerprint is put into its own cell and those
within half that distance (rounded up), so two that are near enough meet in a cell between
them. Those that meet are compared bit by bit.

Only distinct fingerprints take part, so copies cost nothing. Cells that may hold more than
about ``HOT`` fingerprints are found from the counts of full cells and cut into blocks; each
pair of blocks is one group, so no task holds a whole hot cell. Tasks hand on a spanning
forest of what they link, never all pairs.

Defined cases: a null or empty text has fingerprint zero and links like any other; equal
texts, also in rows with the same id, share a fingerprint; a null id belongs to a component
but names it only if no other id does (then null); an empty table gives no rows; other columns are ignored.
A text longer than a part is a part of its own, held whole with a hash per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from kerbside.llm.common import checkpointed, by_chunk, two_columns
from kerbside.llm.components import components, forest

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Bits of a segment; popcounts run from 0 to SEGMENT.
SEGMENT = 2
SEGMENTS = 64 // SEGMENT
GROUPS = 2
#: Fingerprints in a cell, above which it is cut.
HOT = 4096
#: Links a task holds before it reduces them to a forest.
HELD_LINKS = 1 << 20


def fingerprints(texts: list[bytes], shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    hashes: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        if len(words) <= shingle:
            hashes.append(digest(b" ".join(words), SEED))
            sizes[i] = 1
            continue
        joined, at, starts = b" ".join(words), 0, [0]
        for word in words:
            at += len(word) + 1
            starts.append(at)
        n = len(words) - shingle + 1
        hashes += [digest(joined[b : e - 1], SEED) for b, e in zip(starts[:n], starts[shingle:], strict=True)]
        sizes[i] = n
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(sizes)
    if some.size:
        values = np.array(hashes, np.uint64)
        bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(sizes) - sizes)[some]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        major = (2 * ones > sizes[some, None]).astype(np.uint8)
        out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def popcounts(prints: np.ndarray) -> np.ndarray:
    """The embedding: ones in each segment."""
    shifts = np.arange(0, 64, SEGMENT, dtype=np.uint64)
    segments = prints[:, None] >> shifts & np.uint64((1 << SEGMENT) - 1)
    return np.bitwise_count(segments).astype(np.int64)


def cells(counts: np.ndarray, groups: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) for every cell of every group within ``reach`` of the row's own."""
    width = SEGMENTS // groups
    rows, keys = [], []
    for group in range(groups):
        values = counts[:, group * width : (group + 1) * width if group + 1 < groups else SEGMENTS]
        steps = (SEGMENT + 1) ** np.arange(values.shape[1], dtype=np.int64)
        row, key = np.arange(len(values)), values @ steps
        for step in range(reach):
            if step:
                values = key[:, None] // steps % (SEGMENT + 1)
            up_row, up_at = np.nonzero(values < SEGMENT)
            down_row, down_at = np.nonzero(values > 0)
            key = np.concatenate([key, key[up_row] + steps[up_at], key[down_row] - steps[down_at]])
            row = np.concatenate([row, row[up_row], row[down_row]])
            if step:
                row, key = np.unique(np.stack([row, key]), axis=1)
        rows.append(row)
        keys.append(key * groups + group)
    return np.concatenate(rows), np.concatenate(keys)


def near_in_cells(cell: np.ndarray, side: np.ndarray, prints: np.ndarray, max_bits: int):
    """Links within each run of equal cells; where ``side`` is not 0, only between unlike sides."""
    found_a, found_b, held = [], [], 0
    last = np.r_[np.flatnonzero(cell[1:] != cell[:-1]), len(cell) - 1] if len(cell) else np.zeros(0, np.int64)
    room = np.repeat(last, np.diff(np.r_[-1, last])) - np.arange(len(cell))
    at, apart = np.flatnonzero(room > 0), 1
    while at.size:
        a, b = prints[at], prints[at + apart]
        near = (np.bitwise_count(a ^ b) <= max_bits) & (a != b) & ((side[at] == 0) | (side[at] != side[at + apart]))
        found_a.append(a[near])
        found_b.append(b[near])
        held += int(near.sum())
        if held > HELD_LINKS:
            a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b, held = [a], [b], 0
        apart += 1
        at = at[room[at] >= apart]
    none = np.zeros(0, np.uint64)
    return forest(np.concatenate([none, *found_a]), np.concatenate([none, *found_b]))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, groups: int = GROUPS, hot: int = HOT) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (``fp``, long) within ``max_bits``."""
    reach = -(-(max_bits // groups) // 2)

    def place(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 50_000):
                prints = _unsigned(batch.column(0).slice(begin, 50_000))
                row, cell = cells(popcounts(prints), groups, reach)
                yield pa.RecordBatch.from_arrays([pa.array(cell), _signed(prints[row])], names=["cell", "fp"])

    def own(batches):
        for batch in batches:
            row, cell = cells(popcounts(_unsigned(batch.column(0))), groups, 0)
            yield pa.RecordBatch.from_arrays([pa.array(cell), _signed(_unsigned(batch.column(0))[row])], names=["cell", "fp"])

    # A cell holds what stands in its neighbours' own cells. Own cells under this many
    # fingerprints add up to less than ``hot``, so only the fuller ones are counted.
    neighbours = (2 * SEGMENTS // groups) ** reach + 1
    full = (
        distinct.mapInArrow(own, "cell long, fp long")
        .groupBy("cell")
        .agg(F.count("*").alias("n"), F.min("fp").alias("fp"))
        .where(F.col("n") > max(1, hot // neighbours))
    )

    def around(batches):
        for batch in batches:
            own_cell = batch.column(0).to_numpy(zero_copy_only=False)
            row, cell = cells(popcounts(_unsigned(batch.column(2))), groups, reach)
            same = cell % groups == own_cell[row] % groups
            n = batch.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(cell[same]), pa.array(n[row[same]])], names=["cell", "n"])

    hot_cells = (
        full.mapInArrow(around, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > hot)
        .select("cell", F.ceil((F.col("n") + hot) / hot).cast("int").alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    placed = (
        distinct.mapInArrow(place, "cell long, fp long")
        .join(hot_cells, "cell", "left")
        .select("cell", "fp", "blocks", F.when(F.col("blocks").isNull(), 0).otherwise(mine).alias("block"))
        .withColumn("other", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.expr("sequence(0, blocks - 1)"))))
        .select(
            "cell",
            "fp",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            # A pair of unlike blocks compares the one with the other; a block with itself, all its own.
            F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"),
        )
    )
    group = F.xxhash64("cell", "i", "j")
    sorted_ = placed.withColumn("g", group).repartition("g").sortWithinPartitions("g", "cell", "i", "j").select("g", "fp", "side")

    def compare(batches):
        rest = None
        for batch in batches:
            g, side = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            prints = _unsigned(batch.column(1))
            if rest is not None:
                g, prints, side = (np.concatenate(pair) for pair in zip(rest, (g, prints, side), strict=True))
            begin = int(np.searchsorted(g, g[-1])) if len(g) else 0  # the last group may go on
            rest = g[begin:], prints[begin:], side[begin:]
            a, b = near_in_cells(g[:begin], side[:begin], prints[:begin], max_bits)
            yield pa.RecordBatch.from_arrays([_signed(a), _signed(b)], names=["a", "b"])
        if rest is not None:
            a, b = near_in_cells(rest[0], rest[2], rest[1], max_bits)
            yield pa.RecordBatch.from_arrays([_signed(a), _signed(b)], names=["a", "b"])

    return sorted_.mapInArrow(compare, "a long, b long")


def _components(prints: DataFrame, max_bits: int, hot: int) -> DataFrame:
    """(fp, root) of every distinct fingerprint of ``prints``."""
    distinct = checkpointed(prints.select("fp").distinct())
    roots = components(links(distinct, max_bits, hot=hot)).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    hot: int = HOT,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; components of links within ``max_bits`` bits."""
    rows = two_columns(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    prints = checkpointed(rows.mapInArrow(by_chunk(lambda texts: [_signed(fingerprints(texts, shingle))], ["fp"]), f"doc_id {kind}, fp long"))
    labelled = _components(prints, max_bits, hot)
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    first = labelled.join(smallest, "fp").groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = labelled.join(first, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(found, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    hot: int = HOT,
) -> DataFrame:
    """The rows of ``docs``, one of each component: that with the smallest id, then the smallest hash of its text.

    A null id comes last; of rows that are equal in id and text, any one stays.
    """
    rows = two_columns(docs, id_col, text_col, carry=True).withColumn("th", F.xxhash64("text"))
    slim = rows.select("doc_id", "text", "th")
    schema = StructType([rows.schema["doc_id"], StructField("fp", LongType()), rows.schema["th"]])
    prints = checkpointed(slim.mapInArrow(by_chunk(lambda texts: [_signed(fingerprints(texts, shingle))], ["fp"], ("th",)), schema))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    smallest = prints.groupBy("fp").agg(F.min(order).alias("first"))
    first = _components(prints, max_bits, hot).join(smallest, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = first.select(F.col("first.doc_id").alias("kept_id"), F.col("first.th").alias("kept_th"))
    found = rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows["th"] == kept["kept_th"]))
    equal = Window.partitionBy("kept_id", "kept_th").orderBy(F.lit(0))
    return found.withColumn("n", F.row_number().over(equal)).where("n = 1").select("row.*")
