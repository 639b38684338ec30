"""Byte-level BPE over padded numpy matrices.

Each distinct piece of a chunk is one row of a matrix; pieces of similar length share a
matrix. In every round each unfinished row finds the smallest rank among its neighbouring
pairs through a hashed pair table, merges its leftmost pair of that rank, and closes the gap.
Finished rows leave the matrix. Rows of over LONG bytes merge, from the left, all pairs of
the smallest rank at once where no pair with the merged token has a smaller rank; the order
of single merges would give the same tokens.

Defined cases: a null or empty text has no tokens (digests of the empty string); repeated rows are encoded
each; text that looks like a special token is ordinary text; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kerbside.llm.common import ragged, text_chunks, two_columns

#: Upper bounds of the length buckets; longer pieces form matrices with similar rows.
BUCKETS = (2, 4, 6, 8, 12, 16, 24, 32, 64)
LONG = 64
#: Cells of a matrix at once.
CELLS = 1 << 20
#: Distinct pieces whose tokens a task remembers before it starts anew.
REMEMBERED = 400_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank. Ranks must run from 0 without gaps."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PairTable:
    """(left rank, right rank) to merged rank: open addressing over numpy arrays."""

    def __init__(self, tokens: list[bytes]):
        ranks = {token: rank for rank, token in enumerate(tokens)}
        keys, merged = [], []
        for rank, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        keys = np.array(keys, np.uint64)
        merged = np.array(merged, np.int64)
        bits = max(4, int(len(keys) * 2).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.full(1 << bits, len(tokens), np.int32)
        self.none = len(tokens)
        slot, rest = self._slot(keys), np.arange(len(keys))
        while rest.size:
            free = rest[self.keys[slot[rest]] == np.uint64(0xFFFFFFFFFFFFFFFF)]
            self.keys[slot[free]] = keys[free]
            placed = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[placed]] = merged[placed]
            rest = rest[self.keys[slot[rest]] != keys[rest]]
            slot[rest] = slot[rest] + np.uint64(1) & self.mask
        left, right = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        #: Whether no pair that holds the token has a smaller rank than the token itself.
        self.ordered = np.ones(len(tokens) + 1, bool)
        self.ordered[left[merged < left]] = False
        self.ordered[right[merged < right]] = False

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged rank of each pair, ``none`` where there is none."""
        keys = (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)).ravel()
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], np.int32(self.none))
        rest = np.flatnonzero((found != keys) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while rest.size:
            slot[rest] = slot[rest] + np.uint64(1) & self.mask
            found = self.keys[slot[rest]]
            hit = found == keys[rest]
            out[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (found != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out.reshape(left.shape)


class Encoder:
    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.whole = {token: rank for rank, token in enumerate(tokens)}
        self.pairs = PairTable(tokens)
        self.byte = np.array([self.whole[bytes([b])] for b in range(256)], np.int32)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.token_sizes, self.token_starts = sizes, np.cumsum(sizes) - sizes
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in turn, and how many each has."""
        counts = np.ones(len(pieces), np.int64)
        single = np.fromiter((self.whole.get(p, -1) for p in pieces), np.int64, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        rest = np.flatnonzero(single < 0)
        rest = rest[np.argsort(sizes[rest], kind="stable")]
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        bounds = np.searchsorted(sizes[rest], (0, *BUCKETS), side="right")
        for begin, end in zip(bounds, [*bounds[1:], len(rest)], strict=True):
            at = begin
            while at < end:
                rows = max(1, CELLS // int(sizes[rest[min(end - 1, at + CELLS // int(max(1, sizes[rest[at]])))]]))
                if sizes[rest[at]] > LONG:  # similar rows only
                    rows = min(rows, max(1, int(np.searchsorted(sizes[rest[at:end]], 2 * sizes[rest[at]]))))
                some = rest[at : min(end, at + rows)]
                parts.append((some, *self._merge([pieces[i] for i in some], sizes[some])))
                at += len(some)
        for some, _, n in parts:
            counts[some] = n
        starts = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), np.int32)
        known = np.flatnonzero(single >= 0)
        ids[starts[known]] = single[known]
        for some, flat, n in parts:
            ids[ragged(starts[some], n)] = flat
        return ids, counts

    def _merge(self, pieces: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width, none = int(sizes.max()), self.pairs.none
        inside = np.arange(width) < sizes[:, None]
        matrix = np.zeros((len(pieces), width), np.int32)
        matrix[inside] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        left = sizes.copy()
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = np.arange(len(pieces))
        ranks = np.full((len(pieces), max(1, width - 1)), none, np.int32)
        if width > 1:
            both = inside[:, 1:]
            ranks[both] = self.pairs.look_up(matrix[:, :-1][both], matrix[:, 1:][both])
        while rows.size:
            lowest = ranks.min(axis=1)
            over = lowest == none
            if over.any():
                done.append((rows[over], matrix[over], left[over]))
                go = ~over
                rows, left, lowest = rows[go], left[go], lowest[go]
                if not rows.size:
                    break
                width = int(left.max())
                matrix, ranks = matrix[go, :width], ranks[go, : max(1, width - 1)]
            if width > LONG:
                matrix, ranks, left = self._merge_many(matrix, ranks, left, lowest)
            else:
                at = ranks.argmin(axis=1)
                each = np.arange(len(rows))
                matrix[each, at] = lowest
                shift = np.arange(1, width - 1) if width > 2 else np.zeros(0, np.int64)
                # Close the gap: what stands behind the merged pair moves one place to the left.
                moved = shift > at[:, None]
                matrix[:, 1 : width - 1] = np.where(moved, matrix[:, 2:width], matrix[:, 1 : width - 1])
                ranks[:, 1 : width - 2] = np.where(moved[:, : width - 3], ranks[:, 2 : width - 1], ranks[:, 1 : width - 2])
                left -= 1
                ranks[each, np.minimum(left - 1, ranks.shape[1] - 1)] = none
                for side in (at - 1, at):
                    near = np.flatnonzero((side >= 0) & (side + 1 < left))
                    ranks[near, side[near]] = self.pairs.look_up(matrix[near, side[near]], matrix[near, side[near] + 1])
        order = np.concatenate([r for r, _, _ in done])
        counts = np.empty(len(pieces), np.int64)
        counts[order] = np.concatenate([n for _, _, n in done])
        starts = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.int32)
        for some, cells, n in done:
            flat[ragged(starts[some], n)] = cells[np.arange(cells.shape[1]) < n[:, None]]
        return flat, counts

    def _merge_many(self, matrix, ranks, left, lowest):
        """One round over long rows: every pair of the smallest rank, if that rank is ordered."""
        n, width = matrix.shape
        place = np.arange(ranks.shape[1])
        hit = ranks == lowest[:, None]
        # Of pairs that overlap, those at an even distance from the first of their run are merged.
        first = np.where(hit & ~np.pad(hit, ((0, 0), (1, 0)))[:, :-1], place, 0)
        hit &= (place - np.maximum.accumulate(first, axis=1)) % 2 == 0
        alone = ~self.pairs.ordered[lowest]
        if alone.any():
            only = np.zeros_like(hit[alone])
            only[np.arange(len(only)), hit[alone].argmax(axis=1)] = True
            hit[alone] = only
        row, at = np.nonzero(hit)
        matrix[row, at] = lowest[row]
        keep = np.arange(width) < left[:, None]
        keep[row, at + 1] = False
        at = at - (np.arange(len(row)) - np.searchsorted(row, row))  # so many cells before it are gone
        left = keep.sum(axis=1)
        width = int(left.max())
        inside = np.arange(width) < left[:, None]
        closed = np.zeros((n, width), np.int32)
        closed[inside] = matrix[keep]
        was, ranks = ranks, np.full((n, width), self.pairs.none, np.int32)
        ranks[inside] = np.pad(was, ((0, 0), (0, 1)), constant_values=self.pairs.none)[keep]
        ranks[np.arange(n), left - 1] = self.pairs.none
        ranks = ranks[:, : max(1, width - 1)]
        for side in (at - 1, at):
            near = np.flatnonzero((side >= 0) & (side + 1 < left[row]))
            r, c = row[near], side[near]
            ranks[r, c] = self.pairs.look_up(closed[r, c], closed[r, c + 1])
        return closed, ranks, left

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        sizes = self.token_sizes[ids]
        return self.token_bytes[ragged(self.token_starts[ids], sizes)].tobytes()


class TextEncoder:
    """Whole texts: pieces by the pattern, then the ids of each distinct piece."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.encoder = Encoder(tokens)
        self.pieces = regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32)]
        self.counts = [np.zeros(0, np.int64)]
        self.decimal: list[str] = []

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """All ids in turn, the ids of each text, and their decimals joined by spaces."""
        if len(self.known) > REMEMBERED:
            self._forget()
        split = [self.pieces(text.decode()) for text in texts]
        new = list(dict.fromkeys(p for pieces in split for p in pieces if p not in self.known))
        if new:
            ids, counts = self.encoder.encode([p.encode() for p in new])
            for piece in new:
                self.known[piece] = len(self.known)
            words, at = list(map(str, ids.tolist())), 0
            for n in counts.tolist():
                self.decimal.append(" ".join(words[at : at + n]))
                at += n
            self.ids, self.counts = [np.concatenate([*self.ids, ids])], [np.concatenate([*self.counts, counts])]
        ids, counts = self.ids[0], self.counts[0]
        starts = np.cumsum(counts) - counts
        per_text = [np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces)) for pieces in split]
        flat = np.concatenate([np.zeros(0, np.int64), *per_text])
        text_sizes = np.array([int(counts[p].sum()) for p in per_text], np.int64)
        joined = [" ".join(map(self.decimal.__getitem__, p.tolist())) for p in per_text]
        return ids[ragged(starts[flat], counts[flat])], text_sizes, joined


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Each text's token ids (if ``with_ids``), their number and digest, and the digest of the decoded bytes.

    Rows stay in their tasks; nothing is shuffled. The rank file is read on the driver and
    sent to each executor once.
    """
    spark = docs.sparkSession
    tokens = spark.sparkContext.broadcast(load_ranks(ranks_path))
    rows = two_columns(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = TextEncoder(tokens.value, pattern)
        for batch in batches:
            for begin, end, texts in text_chunks(batch):
                ids, counts, decimal = encoder(texts)
                ends = np.cumsum(counts)
                mine = [ids[e - n : e] for e, n in zip(ends, counts, strict=True)]
                columns = [
                    batch.column(0).slice(begin, end - begin),
                    pa.array(counts),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decimal]),
                    pa.array([hashlib.sha256(encoder.encoder.decode(i)).hexdigest() for i in mine]),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids, pa.int32())))
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = SCHEMA.replace("doc_id long", f"doc_id {id_type}") + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(run, schema)
