"""Merkle manifest of a data set as a persistent tree: tampered leaves make versions that copy only their own ancestors.

A leaf is the digest of a row's fields. The leaves of a source, by id, are the lowest nodes of its tree; every ``ARITY``
consecutive nodes (the last run may be shorter) are digested to their parent, until one is left: the source's own root. These,
by source, are the leaves of the tree above, whose root stands for the data set.

A tree is stored in aligned blocks of ``ARITY ** depth`` nodes of a level. Upwards, each block gives one node of the next stored
level. Downwards, each block learns the siblings on its own way to the root, which all its leaves share. A block builds its
nodes once; a leaf whose row was tampered with then makes a version: new ancestors up to the block's root, all other nodes being
those of the first version, and from there on new ancestors along the shared siblings, in the same task. So the versions, as many
as there are rows, are spread as the blocks are, and no task holds more than a block and its versions' roots.

Positions come from one range sort by (source, id, digest) whose parts are numbered by counts, so a source of any size is spread
over many tasks. Null sources are a source of their own, which comes first. Null ids come last in their source; rows that repeat
an id, or have none, are leaves of their own in the order of their digests, equal rows in any order. An empty table gives no
rows. Other columns are ignored. Rows without an id are never tampered with.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..sinks.staging import stage

ARITY, DEPTH = 3, 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_BITS = 33
_NODES = "tree string, pos long, m long, digest binary"


def leaf_digest(**instead: Column) -> Column:
    """The digest of a row's fields, each ``-`` if null, else its length in bytes, ``:``, and its value."""
    parts = []
    for field in FIELDS:
        value = instead.get(field, F.col(field)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def join_digests(digests: list[bytes]) -> bytes:
    """The digest of nodes one after the other, as hexadecimal text."""
    return sha256(b"".join(digests).hex().encode()).digest()


class Tree:
    """The nodes of a block, level by level; the first version, from which others copy."""

    def __init__(self, leaves: list[bytes], levels: int):
        self.levels = [leaves]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([join_digests(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[list[bytes], list[bytes]]]:
        """What stands left and right of the nodes from a leaf to below the root."""
        out = []
        for nodes in self.levels[:-1]:
            first = at - at % ARITY
            out.append((nodes[first:at], nodes[at + 1 : first + ARITY]))
            at //= ARITY
        return out

    def version(self, at: int, leaf: bytes) -> list[bytes]:
        """The nodes that differ once a leaf is another: it and its ancestors, the new root last."""
        return copied(leaf, self.siblings(at))


def copied(leaf: bytes, way: list[tuple[list[bytes], list[bytes]]]) -> list[bytes]:
    """A node and its new ancestors along the siblings that it shares with the first version."""
    nodes = [leaf]
    for left, right in way:
        nodes.append(join_digests([*left, nodes[-1], *right]))
    return nodes


def _levels(m: int) -> int:
    """Levels above ``m`` nodes until one is left."""
    count = 0
    while m > 1:
        m, count = -(-m // ARITY), count + 1
    return count


def _pack(way: list[tuple[list[bytes], list[bytes]]]) -> bytes:
    return b"".join(bytes([len(left), len(right)]) + b"".join(left + right) for left, right in way)


def _unpack(data: bytes) -> list[tuple[list[bytes], list[bytes]]]:
    way, at = [], 0
    while at < len(data):
        n, both = data[at], data[at] + data[at + 1]
        nodes = [data[at + 2 + 32 * i : at + 34 + 32 * i] for i in range(both)]
        way.append((nodes[:n], nodes[n:]))
        at += 2 + 32 * both
    return way


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _flush(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _batched(rows: Iterator[tuple], schema: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    names, types = [n for n, _ in schema], [t for _, t in schema]
    waiting: list[tuple] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == 4096:
            yield _flush(waiting, names, types)
            waiting = []
    if waiting:
        yield _flush(waiting, names, types)


_NODE_TYPES = [("tree", pa.string()), ("pos", pa.int64()), ("m", pa.int64()), ("digest", pa.binary())]


def _parents(depth: int):
    size = ARITY**depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One node per block of sorted nodes (tree, pos, m, digest)."""

        def blocks() -> Iterator[tuple]:
            for (tree, block, m), rows in groupby(_rows(batches), key=lambda r: (r[0], r[1] // size, r[2])):
                nodes = Tree([r[3] for r in rows], min(depth, _levels(m)))
                yield tree, block, -(-m // size), nodes.root

        return _batched(blocks(), _NODE_TYPES)

    return run


def _ways(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each node of sorted blocks its siblings up to the root; a block's own way (``pos`` -1) comes before its nodes."""

        def blocks() -> Iterator[tuple]:
            for (tree, block), rows in groupby(_rows(batches), key=lambda r: (r[0], r[1])):
                *_, m, _, above = next(rows)
                leaves = [r[4] for r in rows]
                nodes = Tree(leaves, min(depth, _levels(m)))
                for at in range(len(leaves)):
                    yield tree, block * ARITY**depth + at, _pack(nodes.siblings(at)) + above

        return _batched(blocks(), [("tree", pa.string()), ("pos", pa.int64()), ("way", pa.binary())])

    return run


_PROOF_TYPES = [
    ("doc_id", pa.int64()),
    ("leaf", pa.binary()),
    ("subroot", pa.binary()),
    ("proof", pa.binary()),
    ("folded", pa.binary()),
]


def _proofs(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Proof and version of every leaf of sorted blocks; a block's way and its source's root come before its leaves."""

        def blocks() -> Iterator[tuple]:
            for _, rows in groupby(_rows(batches), key=lambda r: (r[0], r[1])):
                *_, m, subroot, above, _, _ = next(rows)
                own = [(r[4], r[6], r[7]) for r in rows]
                nodes = Tree([leaf for leaf, _, _ in own], min(depth, _levels(m)))
                shared = _unpack(above)
                for at, (leaf, tampered, doc) in enumerate(own):
                    way = nodes.siblings(at) + shared
                    proof = join_digests([x for left, right in way for x in left + right])
                    folded = copied(nodes.version(at, tampered)[-1], shared)[-1]
                    yield doc, leaf, subroot, proof, folded

        return _batched(blocks(), _PROOF_TYPES)

    return run


def placed(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """``pos`` of each row in its tree by ``order``, and ``m``, the tree's size: one range sort, no tree in one task."""
    ordered = nodes.repartitionByRange(F.col("tree"), *order).sortWithinPartitions("tree", *order)
    numbered = stage(ordered.withColumn("_row", F.monotonically_increasing_id()), "llm-merkle-order")
    part = F.shiftright("_row", _ROW_BITS)
    # One row per tree and part of the sort; a tree has no more of them than the sort has parts.
    pieces = numbered.groupBy("tree", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min("_row").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "tree",
        "part",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("m"),
    )
    return (
        numbered.withColumn("part", part)
        .join(broadcast_if_small(pieces), ["tree", "part"])
        .withColumn("pos", F.col("_row") + F.col("shift"))
        .drop("part", "shift", "_row")
    )


def _block(depth: int) -> Column:
    return F.expr(f"pos div {ARITY**depth}")


def _by_block(rows: DataFrame, *order: str) -> DataFrame:
    """Whole blocks in one task each, sorted."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def stored_levels(nodes: DataFrame, depth: int) -> list[DataFrame]:
    """The nodes at every stored level, the lowest first; the last has one node per tree."""
    levels = [nodes.select("tree", "pos", "m", "digest")]
    largest = levels[0].agg(F.max("m")).first()[0] or 1
    while True:
        sorted_nodes = _by_block(levels[-1].withColumn("block", _block(depth)), "pos").select("tree", "pos", "m", "digest")
        levels.append(stage(sorted_nodes.mapInArrow(_parents(depth), _NODES), "llm-merkle-level"))
        largest = -(-largest // ARITY**depth)
        if largest <= 1:
            return levels


def ways(levels: list[DataFrame], tops: DataFrame, depth: int) -> DataFrame:
    """(tree, pos, way) of the lowest but one stored level: ``tops`` gives the way of each tree's root."""
    above = tops.select("tree", F.lit(0).cast("long").alias("pos"), "way")
    for nodes in reversed(levels[1:-1]):
        heads = above.join(nodes.groupBy("tree").agg(F.first("m").alias("m")), "tree")
        heads = heads.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "m", F.lit(None).cast("binary").alias("digest"), "way")
        own = nodes.select("tree", _block(depth).alias("block"), "pos", "m", "digest", F.lit(None).cast("binary").alias("way"))
        above = stage(_by_block(heads.unionByName(own), "pos").mapInArrow(_ways(depth), "tree string, pos long, way binary"), "llm-merkle-ways")
    return above


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, all digests as hexadecimal text, for every row.

    The tampering that the manifest is tried with removes the line ends of texts whose id has an even CRC-32.
    """
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    plain = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # Null sources first, then by their bytes.
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"),
        leaf_digest().alias("digest"),
        leaf_digest(text=plain).alias("tampered"),
    )
    leaves = stage(leaves, "llm-merkle-leaves")
    order = [F.col("doc_id").asc_nulls_last(), F.col("digest"), F.monotonically_increasing_id()]
    leaves = stage(placed(leaves, order), "llm-merkle-leaves")
    levels = stored_levels(leaves, depth)
    subroots = levels[-1].select("tree", F.col("digest").alias("subroot"))
    # The tree of the sources, in blocks of its own.
    sources = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("subroot").alias("digest"))
    sources = stage(placed(sources, [F.col("source")]), "llm-merkle-sources")
    upper = stored_levels(sources, depth)
    top = upper[-1].first()
    if top is None:
        return docs.sparkSession.createDataFrame([], _RESULT)
    nothing = upper[-1].select("tree", F.lit(b"").alias("way"))
    # One more stored level of the same kind: every source's own way up.
    tops = ways([sources, *upper], nothing, depth)
    tops = tops.join(sources.select("source", "pos"), "pos").select(F.col("source").alias("tree"), "way")
    shared = ways(levels, tops, depth)
    sizes = levels[0].groupBy("tree").agg(F.first("m").alias("m")).join(subroots, "tree")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    heads = shared.join(sizes, "tree").select(
        "tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "m", F.col("subroot").alias("digest"), "way",
        none("binary", "tampered"), none("long", "doc_id"),
    )
    own = leaves.select("tree", _block(depth).alias("block"), "pos", "m", "digest", none("binary", "way"), "tampered", "doc_id")
    proved = _by_block(heads.unionByName(own), "pos").mapInArrow(
        _proofs(depth), "doc_id long, leaf binary, subroot binary, proof binary, folded binary"
    )
    text = lambda name: F.lower(F.hex(name))
    root = F.lit(bytes(top["digest"]))
    return proved.select(
        "doc_id",
        text("leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        text(root).alias("root"),
        text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == root).alias("verified"),
    )


_RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
