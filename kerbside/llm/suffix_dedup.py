"""Suffix dedup: remove every byte covered by a string of ``length`` bytes that starts anywhere else too.

Sorting every suffix of a large corpus would move each byte hundreds of times. Equal windows
have equal content-chosen anchors, so only windows that may be equal are brought together:

1. In each window, the substring of ``length // 4`` bytes with the smallest hash is its anchor
   (the leftmost, if several). Neighbouring windows with one anchor form a run; a run is
   described by its anchor's hash and a second, independent hash of all its bytes.
2. Runs are exchanged by anchor. A run that occurs twice is repeated as a whole. Runs with one
   anchor and unlike bytes are contested: some of their windows may be equal.
3. Of each distinct contested run the bytes are fetched and exchanged by anchor, and its
   windows are sorted as suffixes by hashed comparison (suffixes.py). Equal neighbours,
   verified byte by byte, are repeated.

Anchors with more than ``hot`` runs are known from a count before the exchange; their number is
bounded by ``LISTED``, so their list is broadcast. Their runs are dealt by their bytes
instead, and their contested windows one by one, by a 128-bit hash, each window once per
task. Runs that alone occur that often need no exchange. So no task gets more than ``hot``
runs of an anchor, or one row per task of a window.

Defined cases: a null or empty text has no bytes; a text shorter than ``length`` repeats
nothing, though shorter texts may be equal; rows are texts of their own, so repeated rows repeat each other, also with one id or
none; an empty table gives no rows; other columns are ignored unless carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import checkpointed, ragged, slices, text_bytes, text_chunks, trimmed, two_columns
from kerbside.llm.suffixes import Hashed, repeated_windows

LENGTH = 200
#: Runs of an anchor, above which it is hot; more where the list would exceed LISTED.
HOT = 2000
#: Hot anchors, and hot runs, that may be broadcast: 32 MB at most.
LISTED = 1 << 20
#: Text whose runs are found at once; some hundred bytes of memory go with each of its bytes.
RUN_BYTES = 1 << 19
#: Windows sorted at once.
SORTED = 1 << 18

PLAIN, SALTED, DECIDED, NAMED = 0, 1, 2, 3
COVERED, CONTESTED, CONTESTED_HOT = 0, 1, 2


def pieces(texts: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(text, first, last byte) of pieces whose windows are all windows of the texts, each once."""
    out = []
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), RUN_BYTES):
            out.append((i, at, min(len(text), at + RUN_BYTES + length - 1)))
    return out


def runs(texts: list[bytes], length: int, wanted=None, digests: bool = True) -> dict[str, np.ndarray]:
    """The runs of windows of some texts: text, first window, windows less one, anchor's place, hashes.

    ``wanted`` tells from an array of anchors which runs to keep; without ``digests`` the
    hashes of all their bytes are 0.
    """
    k = max(1, length // 4)
    width = length - k + 1
    cut = pieces(texts, length)
    found: list[list[np.ndarray]] = [[np.zeros(0, kind)] for kind in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64)]
    for begin, end in slices([texts[i][b:e] for i, b, e in cut], RUN_BYTES):
        part = cut[begin:end]
        data = b"".join(texts[i][b:e] for i, b, e in part)
        sizes = np.array([e - b for _, b, e in part], np.int64)
        starts = np.cumsum(sizes) - sizes
        h = Hashed(np.frombuffer(data, np.uint8)).grams(k)
        # The smallest hash, and the leftmost of equals, of every ``width`` neighbours.
        key = h & np.uint64(0xFFFFFFFF00000000) | np.arange(len(h), dtype=np.uint64)
        n = len(h) - width + 1
        blocks = np.concatenate([key, np.full(-len(key) % width, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, width)
        forward = np.minimum.accumulate(blocks, axis=1).ravel()
        backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(backward[:n], forward[width - 1 : width - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        owner = np.repeat(np.arange(len(part)), sizes)[:n]
        inside = np.arange(n) + length <= (starts + sizes)[owner]
        change = np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1]), True]
        edges = np.flatnonzero(change)
        first, last = edges[:-1], edges[1:] - 1
        first, last = first[inside[first]], last[inside[first]]
        if wanted is not None:
            kept = wanted(_long(h[anchor[first]]))
            first, last = first[kept], last[kept]
        place = anchor[first] - first
        view, digest = memoryview(data), xxhash.xxh3_64_intdigest
        spans = zip(first.tolist(), (last + length).tolist(), place.tolist(), strict=True)
        whole = np.zeros(len(first), np.uint64)
        if digests:
            whole = np.fromiter((digest(view[b:e], p) for b, e, p in spans), np.uint64, len(first))
        mine = owner[first]
        text = np.array([i for i, _, _ in part], np.int64)[mine]
        offset = np.array([b for _, b, _ in part], np.int64)[mine] - starts[mine]
        for column, values in zip(found, (text, first + offset, last - first, place, h[anchor[first]], whole), strict=True):
            column.append(values)
    names = ("text", "start", "more", "place", "anchor", "whole")
    return {name: np.concatenate(column) for name, column in zip(names, found, strict=True)}


def _long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _pack(start, more, place):
    return start << 24 | more << 12 | place


def _unpack(pos):
    return pos >> 24, pos >> 12 & 0xFFF, pos & 0xFFF


def _numpy(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def _groups(batches, key: str = "g"):
    """The batches again, cut where ``key`` changes, so that no group spans two."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if not table.num_rows:
            continue
        keys = table.column(key).to_numpy()
        begin = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
        if begin:
            yield table.slice(0, begin).combine_chunks().to_batches()[0]
        rest = table.slice(begin)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks().to_batches()[0]


def anchors_of(rows: DataFrame, length: int) -> DataFrame:
    """(anchor, n): how many runs have each anchor."""

    def run(batches):
        for batch in batches:
            for _, _, texts in text_chunks(batch):
                yield _batch(anchor=_long(runs(texts, length, digests=False)["anchor"]))

    return rows.select("text").mapInArrow(trimmed(run), "anchor long").groupBy("anchor").agg(F.count("*").alias("n"))


def run_rows(rows: DataFrame, length: int, hot, listed=None) -> DataFrame:
    """(anchor, whole, rid, pos, kind, g) of every run of every text; ``g`` deals them out.

    ``hot``: the sorted hot anchors (broadcast); only the rows of hot anchors are kept if
    ``listed`` is None. ``listed``: (whole, anchor, rid, pos) of hot runs, sorted; rid and pos name one of each.
    """

    def is_hot_anchor(anchor):
        return np.isin(anchor, hot.value)

    def run(batches):
        for batch in batches:
            rids = _numpy(batch, "rid")
            for begin, end, texts in text_chunks(batch):
                r = runs(texts, length, is_hot_anchor if listed is None else None)
                anchor, whole, rid = _long(r["anchor"]), _long(r["whole"]), rids[begin:end][r["text"]]
                pos = _pack(r["start"], r["more"], r["place"])
                kind, g = np.zeros(len(rid), np.int8), anchor.copy()
                if listed is not None:
                    is_hot = is_hot_anchor(anchor)
                    kind[is_hot] = SALTED
                    g[is_hot] ^= whole[is_hot]
                    names, name_anchor, name_rid, name_pos = listed.value
                    if len(names):
                        known = np.minimum(np.searchsorted(names, whole), len(names) - 1)
                        decided = is_hot & (names[known] == whole) & (name_anchor[known] == anchor)
                        named = decided & (name_rid[known] == rid) & (name_pos[known] == pos)
                        kind[decided], kind[named] = DECIDED, NAMED
                        g[decided] = rid[decided]
                yield _batch(anchor=anchor, whole=whole, rid=rid, pos=pos, kind=kind, g=g)

    return rows.select("rid", "text").mapInArrow(trimmed(run), "anchor long, whole long, rid long, pos long, kind byte, g long")


def classify(dealt: DataFrame) -> DataFrame:
    """(rid, pos, anchor, what): runs that are repeated, and distinct runs that are contested."""

    def run(batches):
        for batch in _groups(batches):
            g, anchor, whole, rid, pos, kind = (_numpy(batch, n) for n in ("g", "anchor", "whole", "rid", "pos", "kind"))
            one = np.r_[True, (g[1:] != g[:-1]) | (anchor[1:] != anchor[:-1])]
            each = np.r_[True, one[1:] | (whole[1:] != whole[:-1])]
            run_of = np.cumsum(each) - 1
            anchor_of = np.cumsum(one) - 1
            times = np.bincount(run_of)[run_of]
            unlike = np.bincount(anchor_of[each])[anchor_of]
            covered = (times > 1) & (kind < DECIDED) | (kind >= DECIDED)
            plain = each & (kind == PLAIN) & (unlike > 1)
            hot = each & (kind == SALTED) | (kind == NAMED)
            for rows, what in ((covered, COVERED), (plain, CONTESTED), (hot, CONTESTED_HOT)):
                n = int(rows.sum())
                yield _batch(rid=rid[rows], pos=pos[rows], anchor=anchor[rows], what=np.full(n, what, np.int8))

    ordered = dealt.repartition("g").sortWithinPartitions("g", "anchor", "whole", "rid", "pos")
    return ordered.mapInArrow(trimmed(run), "rid long, pos long, anchor long, what byte")


def fragments(asked: DataFrame, length: int) -> DataFrame:
    """The bytes of contested runs; hot ones window by window, each window once per task.

    (g, kind, place, rid, start, bytes). Of a hot window ``bytes`` is its digest, and ``place`` tells whether
    the task saw it more than once; then its other occurrences are handed on as decided.
    """

    def run(batches):
        digests, owners, places = [], [], []
        for batch in batches:
            texts, rids, asked_of = text_bytes(batch), _numpy(batch, "rid"), batch.column("asked")
            sizes = np.diff(asked_of.offsets.to_numpy())
            fields = asked_of.flatten()
            pos, anchor, what = (fields.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            start, more, place = _unpack(pos)
            owner = np.repeat(np.arange(len(texts)), sizes)
            plain = np.flatnonzero(what == CONTESTED)
            cut = zip(owner[plain].tolist(), start[plain].tolist(), (start + more)[plain].tolist(), strict=True)
            taken = pa.array([texts[o][b : e + length] for o, b, e in cut], pa.binary())
            kind = np.full(len(plain), PLAIN, np.int8)
            yield _batch(g=anchor[plain], kind=kind, place=place[plain], rid=rids[owner[plain]], start=start[plain], bytes=taken)
            hot = np.flatnonzero(what == CONTESTED_HOT)
            for o, b, m in zip(owner[hot].tolist(), start[hot].tolist(), more[hot].tolist(), strict=True):
                view = memoryview(texts[o])
                digests += [xxhash.xxh3_128_digest(view[i : i + length]) for i in range(b, b + m + 1)]
            owners.append(np.repeat(rids[owner[hot]], more[hot] + 1))
            places.append(ragged(start[hot], more[hot] + 1))
        if not digests:
            return
        keys = np.frombuffer(b"".join(digests), "S16")
        rid, start = np.concatenate(owners), np.concatenate(places)
        order = np.argsort(keys, kind="stable")
        keys, rid, start = keys[order], rid[order], start[order]
        new = np.r_[True, keys[1:] != keys[:-1]]
        times = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1]
        g = np.where(new, np.ascontiguousarray(keys).view(np.int64).reshape(-1, 2)[:, 0], rid)
        raw = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 16)
        for begin in range(0, len(keys), 100_000):
            s = slice(begin, begin + 100_000)
            taken = pa.array([r.tobytes() for r in raw[s]], pa.binary())
            kind = np.where(new[s], SALTED, DECIDED).astype(np.int8)
            yield _batch(g=g[s], kind=kind, place=np.minimum(times[s], 2), rid=rid[s], start=start[s], bytes=taken)

    return asked.mapInArrow(trimmed(run), "g long, kind byte, place long, rid long, start long, bytes binary")


def repeated_spans(parts: DataFrame, length: int) -> DataFrame:
    """(rid, span) of what is repeated among fragments: windows with one anchor at one place in them are sorted."""

    def plain_spans(g, place, rid, start, taken):
        sizes = np.fromiter(map(len, taken), np.int64, len(taken))
        text = Hashed(np.frombuffer(b"".join(taken), np.uint8))
        n = sizes - length + 1
        row = np.repeat(np.arange(len(taken)), n)
        at = ragged(np.cumsum(sizes) - sizes, n)
        shift = place[row] - ragged(np.zeros(len(n), np.int64), n)  # of the anchor in the window
        new = np.r_[True, g[1:] != g[:-1]]
        segment = (np.cumsum(new) - 1)[row] * (1 << 13) + shift
        order = np.argsort(segment, kind="stable")
        hit = np.zeros(len(at), bool)
        hit[order] = repeated_windows(text, at[order], segment[order], length)
        rows, window = row[hit], ragged(start, n)[hit]
        if not len(rows):
            return rid[:0], rid[:0]
        edges = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1], True])
        # All windows of a run hold its anchor, so the repeated ones cover one span.
        first, last = window[edges[:-1]], window[edges[1:] - 1]
        return rid[rows[edges[:-1]]], first << 24 | last - first + length

    def run(batches):
        for batch in _groups(batches):
            g, kind, place, rid, start = (_numpy(batch, n) for n in ("g", "kind", "place", "rid", "start"))
            plain = np.flatnonzero(kind == PLAIN)
            if len(plain):
                taken = batch.column("bytes").take(pa.array(plain)).to_pylist()
                # Whole groups, some SORTED windows at a time.
                weight = np.cumsum([len(t) - length + 1 for t in taken])
                key = g[plain]
                ends = np.flatnonzero(np.r_[key[1:] != key[:-1], True]) + 1
                begin = 0
                while begin < len(plain):
                    limit = (weight[begin - 1] if begin else 0) + SORTED
                    fit = ends[(ends > begin) & (weight[ends - 1] <= limit)]
                    end = int(fit[-1]) if len(fit) else int(ends[ends > begin][0])
                    some = plain[begin:end]
                    found, span = plain_spans(g[some], place[some], rid[some], start[some], taken[begin:end])
                    yield _batch(rid=found, span=span)
                    begin = end
            single = np.flatnonzero(kind == SALTED)
            if len(single):
                keys = np.array(batch.column("bytes").take(pa.array(single)).to_pylist(), "S16")
                digest = np.unique(keys, return_inverse=True)[1]
                twice = single[(place[single] > 1) | (np.bincount(digest)[digest] > 1)]
                yield _batch(rid=rid[twice], span=start[twice] << 24 | length)
            done = kind == DECIDED
            yield _batch(rid=rid[done], span=start[done] << 24 | length)

    return parts.repartition("g").sortWithinPartitions("g", "kind").mapInArrow(trimmed(run), "rid long, span long")


def cut_out(text: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the maximal removed runs."""
    if not len(spans):
        return text, 0, 0
    start = np.sort(spans)
    start, end = start >> 24, (start >> 24) + (start & 0xFFFFFF)
    end = np.maximum.accumulate(end)
    first = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    start, end = start[first], end[np.r_[first[1:] - 1, len(end) - 1]]
    kept = [text[b:e] for b, e in zip([0, *end.tolist()], [*start.tolist(), len(text)], strict=True)]
    return b"".join(kept), int((end - start).sum()), len(start)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    hot: int = HOT,
    with_kept: bool = True,
    carry: bool = False,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    ``with_kept`` adds what is left: ``kept``, its bytes, and ``kept_text``, the same without
    parts of characters. ``carry`` adds the whole row of the input as ``row``.
    """
    if not 4 <= length <= 4000:
        raise ValueError("length must be from 4 to 4000 bytes")
    spark = docs.sparkSession
    rows = two_columns(docs, id_col, text_col, carry).withColumn("rid", F.xxhash64("doc_id", "text"))

    counts = anchors_of(rows, length)
    limit = hot
    while True:
        full = counts.where(F.col("n") > limit)
        found = full.select("anchor", "n").limit(LISTED + 1).toPandas()
        if len(found) <= LISTED:
            break
        limit *= 4
    anchors = spark.sparkContext.broadcast(np.sort(found["anchor"].to_numpy(np.int64)))
    if len(anchors.value):
        named = (
            run_rows(rows, length, anchors)
            .groupBy("anchor", "whole")
            .agg(F.count("*").alias("n"), F.min(F.struct("rid", "pos")).alias("name"))
            .where(F.col("n") > limit)
            .select("whole", "anchor", "name.rid", "name.pos")
            .toPandas()
            .sort_values("whole")
        )
        listed = spark.sparkContext.broadcast(tuple(named[c].to_numpy(np.int64) for c in ("whole", "anchor", "rid", "pos")))
    else:
        listed = spark.sparkContext.broadcast((np.zeros(0, np.int64),) * 4)
    classes = checkpointed(classify(run_rows(rows, length, anchors, listed)))

    contested = (
        classes.where(F.col("what") != COVERED)
        .groupBy("rid")
        .agg(F.collect_list(F.struct("pos", "anchor", "what")).alias("asked"))
    )
    # Texts are exchanged by rid once; both joins read that exchange.
    asked = rows.join(contested, "rid")
    parts = fragments(asked.select(*rows.columns, "asked"), length)
    pos = F.col("pos")
    covered = classes.where(F.col("what") == COVERED).select(
        "rid",
        F.shiftleft(F.shiftright(pos, 24), 24).bitwiseOR(F.shiftright(pos, 12).bitwiseAND(F.lit(0xFFF)) + length).alias("span"),
    )
    spans = covered.union(repeated_spans(parts, length)).groupBy("rid").agg(F.collect_list("span").alias("spans"))

    def finish(batches):
        for batch in batches:
            spans_of = batch.column("spans")
            for begin, end, texts in text_chunks(batch):
                done = []
                for i, text in enumerate(texts, begin):
                    mine = spans_of[i].values
                    done.append(cut_out(text, np.zeros(0, np.int64) if mine is None else mine.to_numpy()))
                out = {
                    "doc_id": batch.column("doc_id").slice(begin, end - begin),
                    "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                    "n_removed": pa.array([n for _, n, _ in done], pa.int64()),
                    "n_spans": pa.array([n for _, _, n in done], pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(kept).hexdigest() for kept, _, _ in done]),
                }
                if with_kept:
                    out["kept"] = pa.array([kept for kept, _, _ in done], pa.binary())
                    out["kept_text"] = pa.array([kept.decode("utf-8", "ignore") for kept, _, _ in done])
                if carry:
                    out["row"] = batch.column("row").slice(begin, end - begin)
                yield _batch(**out)

    schema = rows.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    schema = schema.add("kept_sha256", "string")
    if with_kept:
        schema = schema.add("kept", "binary").add("kept_text", "string")
    if carry:
        schema = schema.add(rows.schema["row"])
    return rows.join(spans, "rid", "left").select(*rows.columns, "spans").mapInArrow(trimmed(finish), schema)
