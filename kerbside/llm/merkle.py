"""A Merkle manifest of a table: one tree per group of rows, one tree over their roots, a proof per row.

H is the lowercase hex sha256 of its inputs' text, concatenated. A row's leaf is H of its
fields, each as its UTF-8 byte count, ``:`` and the value, or ``-`` if null. The leaves of a
group ascend by id; every two consecutive nodes become their H, a last one without partner
becomes the H of itself, until one remains, the subroot. The subroots, in the order of their
groups (null first, then bytewise), make the root in the same way. A proof has one step per
level up to the root: the sibling's digest, null where a node has no partner, and whether the
sibling stands on the left.

How it is computed. Leaves are hashed in the scan and written without their texts. They are
dealt by range of group, id, leaf and a number that tells equal rows apart, and numbered
within each range; ranges give their sizes, whose running sums are the offsets. Blocks of
2 ** BLOCK consecutive leaves climb by themselves to their top, and the tops of all blocks
climb further in the same way, so a tree of any size takes a few rounds, each with a
thousandth of the nodes of the one before. Proofs use the octopus multiproof: a block finds
the minimal union of coordinates that its proofs need and its own leaves do not give, fetches
those nodes by one join, derives the interiors its proofs share, and expands each proof.

A task holds one block and its fetched nodes at a time. A group of any size, or one row in a
third of the table, is many blocks. The coordinates near a large tree's top are asked for by
many blocks; they meet one row of that node in an inner join, which Spark may split.

Defined cases: null fields count as said; a null id comes first in its
group, and ``verify`` never tampers with it; of equal ids the smaller leaf comes first; repeated rows are leaves each;
a group of one leaf has it as subroot, and one group's subroot is the root; an empty table
gives no rows; a text of any length is hashed in the scan; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbside.llm.common import crc_mod, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that a block of nodes climbs at once.
BLOCK = 10
TAMPERED_OF = 7

_STEP = "struct<left: boolean, digest: string>"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """H of the fields."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def proof_digest(proof: Column) -> Column:
    """H of a proof's siblings."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: step["digest"]), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""

    def step(below: Column, step: Column) -> Column:
        sibling = step["digest"]
        pair = F.when(sibling.isNull(), below).when(step["left"], F.concat(sibling, below)).otherwise(F.concat(below, sibling))
        return F.sha2(pair, 256)

    return F.aggregate(proof, leaf, step)


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(n - 1, 0).bit_length()


def climb(digests: list[str], levels: int) -> list[list[str]]:
    """Consecutive nodes, of which the first has an even index on every level, and their parents level by level."""
    out = [digests]
    for _ in range(levels):
        digests = [digest("".join(digests[i : i + 2])) for i in range(0, len(digests), 2)]
        out.append(digests)
    return out


def missing(at: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The fewest coordinates (level, index) that, with the leaves ``at``, give all their proofs."""
    out, size, known = [], n, np.unique(at)
    for level in range(height(n)):
        siblings = known ^ 1
        out += [(level, int(i)) for i in np.setdiff1d(siblings[siblings < size], known)]
        known, size = np.unique(known >> 1), -(-size // 2)
    return out


def interiors(at: np.ndarray, digests: list[str], n: int, fetched: dict[tuple[int, int], str]) -> tuple[list[tuple[np.ndarray, list[str]]], str]:
    """Per level, the sorted indices and the digests known from the leaves ``at`` and what was fetched; and the root."""
    by_level: dict[int, dict[int, str]] = {}
    for (level, index), value in fetched.items():
        by_level.setdefault(level, {})[index] = value
    known, own, levels = at, digests, []
    for level in range(height(n)):
        more = by_level.get(level, {})
        index = np.concatenate([known, np.fromiter(more, np.int64, len(more))])
        both = [*own, *more.values()]
        order = np.argsort(index, kind="stable")
        index, both = index[order], [both[i] for i in order]
        levels.append((index, both))
        known = np.unique(known >> 1)
        first, after = np.searchsorted(index, 2 * known), np.searchsorted(index, 2 * known + 2)
        own = [digest("".join(both[a:b])) for a, b in zip(first, after, strict=True)]
    return levels, own[0]


def expand(at: np.ndarray, levels: list[tuple[np.ndarray, list[str]]], n: int) -> pa.Array:
    """The proofs of the leaves ``at``: one list of steps each."""
    depth = len(levels)
    taken = np.empty((len(at), depth), np.int64)
    left = np.empty((len(at), depth), bool)
    alone = np.empty((len(at), depth), bool)
    pool: list[str] = []
    size = n
    for level, (index, digests) in enumerate(levels):
        own = at >> level
        sibling = own ^ 1
        alone[:, level] = sibling >= size
        left[:, level] = (own & 1) == 1
        taken[:, level] = len(pool) + np.searchsorted(index, sibling)
        pool += digests
        size = -(-size // 2)
    places = pa.array(taken.ravel(), mask=alone.ravel())
    siblings = pa.array(pool, pa.string()).take(places)
    steps = pa.StructArray.from_arrays([pa.array(left.ravel()), siblings], names=["left", "digest"])
    return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * depth, pa.int32()), steps)


def _with(rows: DataFrame, more: str) -> StructType:
    return StructType([*rows.schema.fields, *StructType.fromDDL(more).fields])


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves``, which has no two equal rows in tree and ``order``, with at, the place in the tree, and n, its leaves."""
    keys = ["tree", *order]

    def count(batches):
        part, tree, rank = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            runs = pc.run_end_encode(batch.column("tree"))
            ranks, begin = np.empty(batch.num_rows, np.int64), 0
            for end, value in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
                if value != tree:
                    tree, rank = value, 0
                ranks[begin:end] = np.arange(rank, rank + end - begin)
                begin, rank = end, rank + end - begin
            more = [pa.array(np.full(batch.num_rows, part), pa.int32()), pa.array(ranks)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "part", "rank"])

    schema = _with(leaves, "part int, rank long")
    ranged = written(leaves.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(count, schema), "merkle-ranges")
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("tree", "part")
        .agg((F.max("rank") + 1).alias("own"))
        .select("tree", "part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"), F.sum("own").over(tree).alias("n"))
    )
    return ranged.join(offsets, ["tree", "part"]).withColumn("at", F.col("before") + F.col("rank")).drop("part", "rank", "before")


def _by_block(rows: DataFrame, level: int = 0) -> DataFrame:
    return rows.withColumn("block", F.shiftright("at", BLOCK)).withColumn("level", F.lit(level))


def _height() -> Column:
    return F.when(F.col("n") <= 1, 0).otherwise(F.length(F.bin(F.col("n") - 1)))


def prove(leaves: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``leaves`` with subroot and proof added, and the subroots by themselves: tree and leaf.

    ``leaves`` is a written table of tree (not null), leaf and further columns; ``order`` names
    those that order the leaves of a tree, no two of which are alike in all of them.
    """
    rows = _by_block(_numbered(leaves, order)).drop("level")

    def bottom(group: pa.Table) -> pa.Table:
        """The block's top, and the coordinates that its proofs are short of."""
        tree, n, block = (group.column(c)[0].as_py() for c in ("tree", "n", "block"))
        order = np.argsort(group.column("at").to_numpy())
        at, own = group.column("at").to_numpy()[order], group.column("leaf").take(pa.array(order)).to_pylist()
        levels = min(BLOCK, height(n))
        wanted = missing(at, n)
        out = [(levels, int(at[0]) >> levels, climb(own, levels)[-1][0]), *((*w, None) for w in wanted)]
        found = pa.table(dict(zip(("level", "at", "digest"), zip(*out, strict=True), strict=True)))
        columns = [pa.array([v] * len(out), t) for v, t in ((tree, pa.string()), (n, pa.int64()), (block, pa.int64()))]
        columns += [found.column("level").cast(pa.int32()), found.column("at").cast(pa.int64()), found.column("digest").cast(pa.string())]
        return pa.table(columns, names=["tree", "n", "block", "level", "at", "digest"])

    slim = rows.select("tree", "n", "block", "at", "leaf")
    first = written(slim.groupBy("tree", "block").applyInArrow(bottom, "tree string, n long, block long, level int, at long, digest string"), "merkle-blocks")
    node = ["tree", "n", "level", "at", "digest"]
    nodes = [first.where(F.col("digest").isNotNull()).select(*node)]

    def upper(group: pa.Table) -> pa.Table:
        """All nodes above the block's own, as far as one block reaches."""
        tree, n, level = (group.column(c)[0].as_py() for c in ("tree", "n", "level"))
        order = np.argsort(group.column("at").to_numpy())
        first, own = group.column("at").to_numpy()[order[0]], group.column("digest").take(pa.array(order)).to_pylist()
        above = climb(own, min(BLOCK, height(n) - level))[1:]
        index = [np.arange(len(d)) + (first >> k) for k, d in enumerate(above, 1)]
        levels = [np.full(len(d), level + k) for k, d in enumerate(above, 1)]
        total = sum(map(len, above))
        columns = [pa.array([tree] * total, pa.string()), pa.array([n] * total, pa.int64())]
        columns += [pa.array(np.concatenate(levels), pa.int32()), pa.array(np.concatenate(index), pa.int64())]
        return pa.table([*columns, pa.array(sum(above, []), pa.string())], names=node)

    tallest = height(first.agg(F.max("n")).first()[0] or 0)
    for level in range(BLOCK, tallest, BLOCK):
        tops = nodes[-1].where((F.col("level") == level) & (_height() > level))
        blocks = _by_block(tops, level).groupBy("tree", "block")
        nodes.append(written(blocks.applyInArrow(upper, "tree string, n long, level int, at long, digest string"), "merkle-nodes"))
    known = reduce(DataFrame.unionByName, nodes)
    subroots = known.where(F.col("level") == _height()).select("tree", F.col("digest").alias("leaf"))
    wanted = first.where(F.col("digest").isNull()).drop("digest", "n")
    fetched = wanted.join(known.drop("n"), ["tree", "level", "at"]).select("tree", "block", "level", "at", "digest")

    schema = _with(leaves, f"subroot string, proof array<{_STEP}>")
    names = leaves.columns

    def expanded(group: pa.Table, more: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.argsort(group.column("at").to_numpy())))
        n, at = group.column("n")[0].as_py(), group.column("at").to_numpy()
        where = zip(more.column("level").to_pylist(), more.column("at").to_pylist(), strict=True)
        levels, subroot = interiors(at, group.column("leaf").to_pylist(), n, dict(zip(where, more.column("digest").to_pylist(), strict=True)))
        return group.select(names).append_column("subroot", pa.array([subroot] * len(at))).append_column("proof", expand(at, levels, n))

    return rows.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(expanded, schema), subroots


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    altered: Column | None = None,
) -> DataFrame:
    """doc_id, leaf, altered (a second digest to carry along, if given), subroot, root and proof of every row."""
    group = docs[group_col].cast("string")
    # A leading digit puts null before all others, the empty text included.
    tree = F.coalesce(F.concat(F.lit("1"), group), F.lit("0"))
    leaves = docs.select(
        docs[id_col].alias("doc_id"),
        tree.alias("tree"),
        leaf_digest(*[docs[f] for f in fields]).alias("leaf"),
        (F.lit(None).cast("string") if altered is None else altered).alias("altered"),
        # Tells equal rows apart, so that they can be dealt to several ranges.
        F.monotonically_increasing_id().alias("copy"),
    )
    proven, subroots = prove(written(leaves, "merkle-leaves"), ["doc_id", "leaf", "copy"])
    above = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "leaf")
    roots, _ = prove(written(above, "merkle-subroots"), ["name"])
    roots = roots.select(F.col("name").alias("tree"), F.col("subroot").alias("root"), F.col("proof").alias("above"))
    return proven.join(roots, "tree").select("doc_id", "leaf", "altered", "subroot", "root", F.concat("proof", "above").alias("proof"))


def verify(docs: DataFrame, divisor: int = TAMPERED_OF) -> DataFrame:
    """Every row's place in the manifest, and whether its proof holds where one row in ``divisor`` has one more in n_chars."""
    changed = [docs[f] + 1 if f == "n_chars" else docs[f] for f in FIELDS]
    tampered = docs["doc_id"].isNotNull() & (crc_mod(docs["doc_id"], divisor) == 0)
    found = manifest(docs, altered=F.when(tampered, leaf_digest(*changed)))
    root = folded(F.coalesce("altered", "leaf"), F.col("proof"))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), root.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
