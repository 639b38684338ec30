"""Token ids packed into rows of fixed capacity, best fit decreasing.

Texts are dealt by a hash into blocks of some ``BLOCK_BYTES``, ordered by the hash, and encoded by
the public tokenizer library in the task that packs them. Ids of texts longer than a row
are split, without loss, into full rows and a rest. A block is packed by itself, at most about
``BLOCK_TOKENS`` tokens at a time: its segments, longest first, each go into the
open row with the least room that still suffices, found in a segment tree over room sizes.
So rows depend on the texts and not on the partitions, and what is held is bounded whatever the table holds.
A row that is repeated within a partition goes, from its second copy on, to blocks by the copy's number, so one
row in a third of the table fills all blocks alike.

Defined cases: a null or empty text has no tokens and stands in no row; a null id is kept as
null in ``doc_ids``; repeated rows are packed each; text that looks like a special token is
ordinary text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.bpe import load_ranks
from kerbside.llm.common import copy_numbers, text_chunks, two_columns

CAPACITY = 2048
#: Text dealt to a block.
BLOCK_BYTES = 4 << 20
BLOCK_TOKENS = 4 << 20
#: Two bytes hold an id of up to this.
SMALL_IDS = 1 << 16


class RoomTree:
    """Open rows by their room: a segment tree over 1 .. capacity that tells the smallest room of at least n."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int) -> None:
        at = room + self.leaves
        self.some[at] = bool(self.rows[room])
        at >>= 1
        while at:
            now = self.some[2 * at] | self.some[2 * at + 1]
            if self.some[at] == now:
                return
            self.some[at] = now
            at >>= 1

    def put(self, row: int, room: int) -> None:
        if room:
            self.rows[room].append(row)
            if len(self.rows[room]) == 1:
                self._mark(room)

    def take(self, least: int) -> tuple[int, int] | None:
        """The (row, room) with the smallest room of at least ``least``, which is then no longer open."""
        if least >= len(self.rows):
            return None
        at = least + self.leaves
        if not self.some[at]:
            while at > 1 and (at & 1 or not self.some[at + 1]):  # up, until something lies to the right
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            self._mark(room)
        return row, room


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Rows as lists of segments; the longest segments first, then as they come."""
    tree, rows = RoomTree(capacity), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = tree.take(size)
        if found is None:
            rows.append([i])
            tree.put(len(rows) - 1, capacity - size)
        else:
            row, room = found
            rows[row].append(i)
            tree.put(row, room - size)
    return rows


def segments(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, offset, size) of the pieces of texts with so many tokens."""
    pieces = -(-counts // capacity)
    text = np.repeat(np.arange(len(counts)), pieces)
    offset = (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
    return text, offset, np.minimum(counts[text] - offset, capacity)


def pack(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per packed row.

    row_id; n_tokens; doc_ids and offsets: of each segment, its text's id and its first
    token's place in that text; cu_seqlens: 0 and where each segment ends; ids: the row of
    the id matrix, little-endian, of 2 bytes each (4 if the vocabulary needs them), filled up
    to ``capacity`` with the first free id; position_ids: likewise, from 0 in each segment.
    """
    tokens = load_ranks(ranks_path)
    sent = docs.sparkSession.sparkContext.broadcast(tokens)
    rows = two_columns(docs, id_col, text_col)
    kind = np.dtype("<u2") if len(tokens) < SMALL_IDS and capacity <= SMALL_IDS else np.dtype("<u4")

    def run(batches):
        ranks = {token: rank for rank, token in enumerate(sent.value)}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        number = block = None
        ids, parts, held = [], [], 0

        def out():
            nonlocal number, ids, parts, held
            flat = np.concatenate(parts) if parts else np.zeros(0, kind)
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            starts = np.cumsum(counts) - counts
            text, offset, size = segments(counts, capacity)
            packed = best_fit(size, capacity)
            for begin in range(0, len(packed), 1000):
                some = packed[begin : begin + 1000]
                matrix = np.full((len(some), capacity), len(ranks), kind)
                places = np.zeros((len(some), capacity), kind)
                ends = []
                for r, row in enumerate(some):
                    at, edge = 0, [0]
                    for i in row:
                        n, first = int(size[i]), int(starts[text[i]] + offset[i])
                        matrix[r, at : at + n] = flat[first : first + n]
                        places[r, at : at + n] = np.arange(n, dtype=kind)
                        at += n
                        edge.append(at)
                    ends.append(edge)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(number, number + len(some)), pa.int64()),
                        pa.array([e[-1] for e in ends], pa.int32()),
                        pa.array([[ids[text[i]] for i in row] for row in some], pa.list_(id_type)),
                        pa.array([[int(offset[i]) for i in row] for row in some], pa.list_(pa.int64())),
                        pa.array(ends, pa.list_(pa.int32())),
                        pa.array([m.tobytes() for m in matrix], pa.binary()),
                        pa.array([p.tobytes() for p in places], pa.binary()),
                    ],
                    names=["row_id", "n_tokens", "doc_ids", "offsets", "cu_seqlens", "ids", "position_ids"],
                )
                number += len(some)
            ids, parts, held = [], [], 0

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            names, blocks = batch.column(0).to_pylist(), batch.column("block").to_pylist()
            for begin, end, texts in text_chunks(batch):
                for name, own, text in zip(names[begin:end], blocks[begin:end], texts, strict=True):
                    if own != block:
                        if ids:
                            yield from out()
                        number, block = own << 32, own
                    ids.append(name)
                    parts.append(encoding.encode_to_numpy(text.decode(), disallowed_special=()).astype(kind))
                    held += len(parts[-1])
                    if held >= BLOCK_TOKENS:
                        yield from out()
        if ids:
            yield from out()

    name = rows.schema["doc_id"].dataType.simpleString()
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    placed = copy_numbers(rows.withColumn("place", F.xxhash64("doc_id", "text")), "place")
    own = F.when(F.col("copy") > 0, F.xxhash64("place", "copy")).otherwise(F.col("place"))
    keyed = placed.withColumn("block", F.pmod(own, F.lit(n_blocks)))
    dealt = keyed.repartition("block").sortWithinPartitions("block", "place")
    return dealt.select("doc_id", "text", "block").mapInArrow(
        run,
        f"row_id long, n_tokens int, doc_ids array<{name}>, offsets array<long>, cu_seqlens array<int>, ids binary, position_ids binary",
    )
