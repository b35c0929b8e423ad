"""N-gram Jaccard join by parity sketches.

A document's set is its distinct 5-word shingles, words in lower case (A-Z); shorter documents have their whole word
sequence as one shingle; documents without words have none and link with nothing. Documents whose sets are equal
form one class, and its first document stands for it.

Each shingle is hashed to one bit of a sketch and flips it, so the sketches of two sets differ in at most as many bits as
the sets differ in elements. Two sets with similarity 0.8 whose smaller size lies in a band up to ``hi`` differ in at most
``hi / 4`` elements. The sketch of a band is cut into more blocks than that: linked documents agree in at least
``spare + 1`` blocks, and meet by a join on their contents. (A block has 2**32 bits, nearly all 0; its
content is kept as the exclusive or of one 64-bit code for each set bit.) An empty block joins nothing, as it says nothing: two documents that
agree in empty blocks alone have more than ``spare`` of them, and only such documents send their empty blocks too.

Rows are sorted by block content and read as a stream; the first document of each content meets all others. What is
verified is linked; where the others of a content still belong to different components, another of them meets
the rest (blocks that very many share, such as those of a common line, are left out as far as each document has blocks to
spare). After ``STAR_ROUNDS`` rounds, documents that still share a block with another component meet by their rarest shingles:
shingles are put in one order, those that only one component has first, then by frequency; linked documents share one
of their first ``n - ceil(0.8 n) + 1``, and the places of the first one they share bound their intersection. So families of documents
that differ too much fall apart without making their pairs, no pair within a group that is already
connected is made, and no connection is lost. Pairs whose whole sketches differ too much are ruled out: these have a bit for
each element, ``SKETCH_BITS`` at least, as a sketch of fewer bits than elements tells long texts apart no more. Verification
compares the whole sets of 64-bit hashes; sets are made for the documents that are compared, and move once they are.

Null texts are empty. Rows that repeat an id, or have none, are documents of their own (see ``rows``). Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.staging import stage
from . import grams
from .rows import ROW, carried, identified, partitions, restored

SHINGLE = 5
RATIO, SPARE, STAR_ROUNDS = 1.4, 0.2, 3
BAND_MASK, SKETCH_BITS = 127, 1024
CHUNK_SHINGLES = 1 << 17
#: Members of one rare shingle that a task compares with as many others at a time.
MEETING_BLOCK = 256


def _bands(largest: int) -> list[tuple[int, int]]:
    """Ranges of set sizes from 4 on; smaller sets only link with equal ones."""
    bands, low = [], 4
    while not bands or bands[-1][1] < largest:
        bands.append((low, int(low * RATIO)))
        low = bands[-1][1] + 1
    return bands


_BANDS = _bands(1 << 40)
_HIGHS = np.array([high for _, high in _BANDS])


def blocks_of(size: int) -> list[tuple[int, int, int]]:
    """The bands in which a set of this size takes part: band, number of blocks, blocks to spare."""
    if size < 4:
        return []
    own = int(np.searchsorted(_HIGHS, size))
    found = []
    for band in (own - 1, own):
        if band < 0 or (band < own and 4 * size > 5 * _BANDS[band][1]):
            continue
        differ = _BANDS[band][1] // 4
        blocks = int((differ + 1) / (1 - SPARE)) + 1
        found.append((band, blocks, blocks - differ - 1))
    return found


def shingle_sets(chunk: grams.Chunk) -> Iterator[np.ndarray]:
    """The sorted 64-bit hashes of each document's shingles."""
    words = grams.words(chunk, lower=True)
    codes = grams.RangeHashes(words.hashes)
    hashes = codes.windows(SHINGLE)
    for first, last in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        n = last - first
        if n >= SHINGLE:
            yield np.unique(hashes[first : last - SHINGLE + 1])
        elif n:
            whole = codes.of(np.array([first]), np.array([last]))
            yield grams.mix(whole, 30 + n)
        else:
            yield np.zeros(0, dtype=np.uint64)


def _blocks(spread: np.ndarray, blocks: int) -> np.ndarray:
    return ((spread >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def spare_blocks(shingles: np.ndarray) -> list[dict[str, int]]:
    """For each band: how many of a set's blocks that aren't empty can be ignored. Its empty ones count as ignored first, sent or
    not: a partner that doesn't send its own shares them all the same."""
    found = []
    for band, blocks, spare in blocks_of(len(shingles)):
        used = len(np.unique(_blocks(grams.mix(shingles, 100 + band), blocks)))
        found.append({"band": band, "spare": max(0, spare - (blocks - used))})
    return found


def block_keys(shingles: np.ndarray) -> np.ndarray:
    """The contents of a set's blocks, each with its band and number hashed in; the lowest bits tell the band."""
    keys = []
    for band, blocks, spare in blocks_of(len(shingles)):
        spread = grams.mix(shingles, 100 + band)
        block = _blocks(spread, blocks)
        order = np.argsort(block)
        used, firsts = np.unique(block[order], return_index=True)
        # One code for each bit (block and low half of the hash): flipped twice, it is gone, as the bit is.
        contents = np.bitwise_xor.reduceat(grams.mix(spread, 1)[order], firsts)
        empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), used) if blocks - len(used) > spare else used[:0]
        where = np.concatenate([used, empty]) | np.uint64(band << 40)
        contents = np.concatenate([contents, np.zeros(len(empty), dtype=np.uint64)])
        own = grams.mix(contents ^ grams.mix(where, 2), 3)
        keys.append((own & ~np.uint64(BAND_MASK)) | np.uint64(band))
    return np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)


def bit_sketch(shingles: np.ndarray, bits: int = SKETCH_BITS) -> bytes:
    """The parity of the shingles hashed to each of ``bits`` bits, a power of two; the two halves of a sketch make the next smaller."""
    counts = np.bincount((grams.mix(shingles, 50) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def wide_sketch(shingles: np.ndarray) -> bytes | None:
    """A sketch of at least a bit for each shingle; None where ``SKETCH_BITS`` are enough."""
    return bit_sketch(shingles, 1 << (len(shingles) - 1).bit_length()) if len(shingles) > SKETCH_BITS else None


def sketch_distances(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """In how many bits the sketches of each pair differ; of unlike ones the larger is folded to the size of the smaller."""
    sizes = np.array([[len(a), len(b)] for a, b in zip(x, y)], dtype=np.int64).reshape(-1, 2)
    found = np.zeros(len(sizes), dtype=np.int64)
    for pair in np.unique(sizes, axis=0):
        own, least = np.flatnonzero((sizes == pair).all(axis=1)), int(pair.min())
        a, b = (
            np.bitwise_xor.reduce(np.frombuffer(b"".join(z[i] for i in own.tolist()), dtype=np.uint64).reshape(len(own), -1, least // 8), axis=1)
            for z in (x, y)
        )
        found[own] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return found


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spares = pa.list_(pa.struct([("band", pa.int32()), ("spare", pa.int32())]))
    for batch in batches:
        rows = []
        for chunk in grams.chunks(batch, ROW, "text"):
            for s in shingle_sets(chunk):
                sums = (int(grams.mix(s, salt).sum(dtype=np.uint64).view(np.int64)) for salt in (41, 42))
                rows.append((len(s), *sums, bit_sketch(s), wide_sketch(s), spare_blocks(s)))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), spares]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(ROW), batch.column("doc_id"), *columns], names=[ROW, "doc_id", "n", "d1", "d2", "sketch", "wide", "spares"]
        )


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = set()
        for chunk in grams.chunks(batch, ROW, "text"):
            keys, ids = [], []
            for i, s in zip(chunk.ids.tolist(), shingle_sets(chunk)):
                sums = (len(s), int(grams.mix(s, 41).sum(dtype=np.uint64)), int(grams.mix(s, 42).sum(dtype=np.uint64)))
                if sums not in seen:  # equal sets of one batch meet once
                    seen.add(sums)
                    keys.append(block_keys(s))
                    ids.append(np.full(len(keys[-1]), i, dtype=np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids))], names=["key", ROW]
                )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: the first document of each key beside every other one.

    ``open``: the key has a third document or more, so its others have yet to meet; its second one comes twice.
    """
    key = lead = last = None
    seen = 0  # documents of the open key so far
    for batch in batches:
        keys, ids = (batch.column(c).to_numpy() for c in ("key", ROW))
        if not len(keys):
            continue
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = keys[1:] != keys[:-1]
        fresh[0] = key is None or keys[0] != key
        place = np.arange(len(keys))
        heads = np.maximum.accumulate(np.where(fresh, place, -1))
        leaders = np.where(heads >= 0, ids[heads], 0 if lead is None else lead)
        nth = place - heads + np.where(heads >= 0, 0, seen - 1)
        before = np.concatenate([[0 if last is None else last], ids[:-1]])
        key, lead, last, seen = keys[-1], leaders[-1], ids[-1], nth[-1] + 1
        others, third = ~fresh, nth == 2
        columns = [np.concatenate([c[others], d[third]]) for c, d in ((keys, keys), (leaders, leaders), (ids, before))]
        open_ = np.concatenate([nth[others] >= 2, np.ones(int(third.sum()), dtype=bool)])
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(open_)], names=["key", "lead", "member", "open"])


def _near(percent: int):
    """Pairs whose sketches don't already show too many differing shingles."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = sketch_distances(*(batch.column(c).to_pylist() for c in ("x", "y")))
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array((100 + percent) * differ <= (100 - percent) * both))

    return read


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in grams.chunks(batch, ROW, "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.ids), pa.array([s.tobytes() for s in shingle_sets(chunk)], pa.binary())], names=["id", "shingles"]
            )


def _without_spares(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """``rows`` (key, member, component) without the most frequent keys of each member, as many as it can spare.

    Linked documents share more blocks than they can spare, so in any one order of all blocks they still share one when
    each leaves out its last ones: empty blocks, then those that most documents share (a common line, say). A set with more
    empty blocks than it can spare sends them and leaves out none.
    """
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_count"))
    spares = sums.select(F.col(ROW).alias("member"), F.explode("spares").alias("s")).select("member", F.col("s.band").alias("band"), "s.spare")
    last = Window.partitionBy("member", "band").orderBy(F.desc("_count"), "key")
    ranked = rows.join(counts, "key").withColumn("band", F.col("key").bitwiseAND(BAND_MASK).cast("int"))
    ranked = ranked.join(spares, ["member", "band"]).withColumn("_rank", F.row_number().over(last))
    return ranked.filter(F.col("_rank") > F.col("spare")).select("key", "member", "component")


def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members, of = (batch.column(c).to_numpy() for c in ("member", "component"))
        sets = [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in batch.column("shingles")]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        part = np.cumsum(sizes) // CHUNK_SHINGLES
        for first, last in zip(*(np.searchsorted(part, np.unique(part), side=side).tolist() for side in ("left", "right"))):
            own = sizes[first:last]
            columns = [np.repeat(c[first:last], own) for c in (members, of, sizes)]
            keys = np.concatenate(sets[first:last]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*map(pa.array, (keys, *columns))], names=["key", "member", "component", "n"])


def _rarest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """key, member, component, n, most: the rarest shingles of each member (member, component) that other components have too.

    Members of different components that are linked share one of them, and neither has more than the other's ``most`` shingles.
    """
    beside = members.join(sets.toDF("member", "shingles"), "member")
    rows = beside.mapInArrow(_each_shingle, "key long, member long, component long, n long")
    known = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("_count"), (F.min("component") < F.max("component")).alias("_shared")
    )
    order = Window.partitionBy("member").orderBy("_shared", "_count", "key")
    ranked = rows.join(known, "key").withColumn("_place", F.row_number().over(order))
    first = ranked.filter(F.col("_shared") & (F.col("_place") <= F.expr(f"n - ({percent} * n + 99) DIV 100 + 1")))
    # Where this is the first shingle they share, the intersection holds n - _place + 1 at most.
    return first.select("key", "member", "component", "n", F.expr(f"({100 + percent} * (n - _place + 1)) DIV {percent} - n").alias("most"))


def _met_in_blocks(percent: int):
    """From rows sorted by key and pair of blocks: the pairs of members that components, sizes, places and sketches allow."""
    run_of = ["key", "low", "high"]

    def meet(run: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        member, component, n, most, block = (run.column(c).to_numpy() for c in ("member", "component", "n", "most", "block"))
        left, right = (np.flatnonzero(block == run.column(c)[0].as_py()) for c in ("low", "high"))
        sketch = np.frombuffer(b"".join(run.column("sketch").to_pylist()), dtype=np.uint64).reshape(len(n), -1)
        found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for i in left.tolist():
            other = right[(component[right] != component[i]) & (n[right] <= most[i]) & (n[i] <= most[right])]
            if run.column("low")[0] == run.column("high")[0]:
                other = other[other > i]
            differ = np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1, dtype=np.int64)
            other = other[(100 + percent) * differ <= (100 - percent) * (n[other] + n[i])]
            found[0].append(np.full(len(other), member[i]))
            found[1].append(member[other])
        x, y = map(np.concatenate, found)
        return np.minimum(x, y), np.maximum(x, y)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the rows of the last run, which the next batch may go on with
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([waiting, rows]).combine_chunks() if waiting is not None else rows
            names = np.stack([rows.column(c).to_numpy() for c in run_of])
            fresh = np.flatnonzero(np.concatenate([[True], (names[:, 1:] != names[:, :-1]).any(axis=0)])) if rows.num_rows else np.zeros(0, np.int64)
            for first, last in zip(fresh[:-1].tolist(), fresh[1:].tolist()):
                if last - first > 1:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, meet(rows.slice(first, last - first)))], names=["x", "y"])
            waiting = rows.slice(int(fresh[-1])) if len(fresh) else waiting
        if waiting is not None and waiting.num_rows > 1:
            yield pa.RecordBatch.from_arrays([*map(pa.array, meet(waiting))], names=["x", "y"])

    return read


def _rare_meetings(rare: DataFrame, sums: DataFrame, percent: int) -> DataFrame:
    """x, y: members of different components that share a key of ``rare`` and may be linked, as far as sizes, places and
    sketches tell.

    The members of a key are dealt into blocks of about ``MEETING_BLOCK``, and every two blocks of it meet in one task.
    What the bounds rule out is never a row; a family of any size is spread over as many tasks as it has pairs of blocks.
    """
    keys = rare.groupBy("key").agg(
        F.min("n").alias("_least"), F.min("component").alias("_first"), F.max("component").alias("_last"), F.count(F.lit(1)).alias("_count")
    )
    keys = keys.filter("_first <> _last").select("key", "_least", F.expr(f"(_count + {MEETING_BLOCK - 1}) DIV {MEETING_BLOCK}").cast("int").alias("blocks"))
    rows = rare.join(keys, "key").filter("most >= _least").drop("_least")
    rows = rows.join(sums.select(F.col(ROW).alias("member"), "sketch"), "member")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("member"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "member", "component", "n", "most", "sketch"
    )
    dealt = rows.repartition(partitions(rare), "key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(_met_in_blocks(percent), "x long, y long")


def _linked(percent: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                a, b = (np.frombuffer(z.as_buffer(), dtype=np.uint64) for z in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return read


def components(edges: DataFrame, name: str = "llm-components") -> DataFrame:
    """id, component: the least id reachable, for every id of ``edges`` (a, b)."""
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), name)
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), name)
    while True:
        told = both.join(labels.toDF("b", "near"), "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        nearer = labels.join(told, "id").select("id", F.least("component", "near").alias("component"), F.col("component").alias("before"))
        # A component's own label may already be smaller: follow it.
        jump = labels.toDF("component", "beyond")
        moved = nearer.join(jump, "component", "left").select(
            "id", F.least("component", F.coalesce("beyond", "component")).alias("component"), "before"
        )
        moved = stage(moved, name)
        labels = moved.select("id", "component")
        if moved.filter("component <> before").limit(1).count() == 0:
            return labels


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked. Only sets of documents in ``pairs`` are moved."""
    ids = stage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "llm-asked")
    sets = sets.join(ids, "id", "left_semi")
    beside = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    return beside.select("a", "b", "left", "right").mapInArrow(_linked(percent), "a long, b long")


def _open(rest: DataFrame, found: DataFrame) -> DataFrame:
    """Of key and member, with its component: the keys that still hold different ones."""
    own = rest.join(found.toDF("member", "component"), "member", "left").withColumn("component", F.coalesce("component", "member"))
    mixed = own.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least <> most")
    return stage(own.join(mixed.select("key"), "key").distinct(), "llm-open")


def similar_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links, its own included) of every document.

    Two documents link when their sets share at least ``percent`` (80 or more) of 100 parts of their union.
    """
    return _components(identified(docs), percent).select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, with all their columns."""
    rows = carried(docs)
    # Written first: its size is known, so the texts are moved only where it is large.
    firsts = stage(_components(rows, percent).filter("first").select(ROW), "llm-firsts")
    return restored(rows.join(firsts, ROW, "left_semi"), docs)


def _components(docs: DataFrame, percent: int) -> DataFrame:
    if not 80 <= percent <= 100:
        raise ValueError("the bands are made for a similarity of 0.8 or more")
    docs = docs.select(ROW, "doc_id", "text").filter(F.col(ROW).isNotNull())
    kinds = f"{ROW} long, doc_id long, n long, d1 long, d2 long, sketch binary, wide binary, spares array<struct<band:int,spare:int>>"
    sums = stage(docs.mapInArrow(_summaries, kinds), "llm-sets")
    classes = sums.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min(ROW).alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = stage(classes, "llm-classes")
    copies = sums.join(classes.filter("copies > 1"), ["n", "d1", "d2"]).filter(F.col(ROW) != F.col("rep"))
    copies = stage(copies.select(F.col(ROW).alias("copy"), "rep"), "llm-copies")

    def standing(rows: DataFrame, *names: str) -> DataFrame:
        """``rows`` with each id in ``names`` replaced by the first document of its class."""
        for name in names:
            found = rows.join(copies.toDF(name, "_rep"), name, "left")
            rows = found.withColumn(name, F.coalesce("_rep", name)).drop("_rep")
        return rows

    def pairs(rows: DataFrame, x: str, y: str) -> DataFrame:
        """Different pairs of ``rows`` that sizes and sketches allow to be linked."""
        known = sums.select(ROW, "n", F.coalesce("wide", "sketch").alias("sketch"))
        both = rows.filter(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()
        both = both.join(known.toDF("a", "n_a", "x"), "a").join(known.toDF("b", "n_b", "y"), "b")
        both = both.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        return both.mapInArrow(_near(percent), "a long, b long")

    def sets_of(ids: DataFrame) -> DataFrame:
        """id, shingles of the documents whose ids are told: a narrow table of known size, so that texts are moved only where it is large."""
        asked = stage(ids.toDF(ROW).distinct(), "llm-asked")
        return stage(docs.join(asked, ROW, "left_semi").mapInArrow(_sets, "id long, shingles binary"), "llm-shingles")

    dealt = docs.mapInArrow(_keys, f"key long, {ROW} long").repartition(partitions(docs), "key").sortWithinPartitions("key", ROW)
    stars = stage(dealt.mapInArrow(_stars, "key long, lead long, member long, open boolean"), "llm-stars")
    met = stage(pairs(standing(stars.select("lead", "member").distinct(), "lead", "member"), "lead", "member"), "llm-pairs")
    rest = stage(standing(stars.filter("open").select("key", "member"), "member").distinct(), "llm-open")
    sets = sets_of(met.select("a").union(met.select("b")))
    edges = stage(_verified(met, sets, percent), "llm-links")
    found = components(edges)
    rest = _without_spares(_open(rest, found), sums).select("key", "member")

    for round_ in range(1, STAR_ROUNDS + 1):
        rest = _open(rest, found)
        if rest.limit(1).count() == 0:
            break
        if round_ == 1:  # all that later rounds compare is in it
            sets = sets.union(sets_of(rest.select(F.col("member").alias("id")).join(sets, "id", "left_anti")))
        if round_ < STAR_ROUNDS:
            order = F.xxhash64("member", F.lit(round_))
            # A leader meets all others and leaves.
            leads = rest.groupBy("key").agg(F.min(F.struct(order.alias("order"), F.col("member").alias("lead"), F.col("component").alias("of"))).alias("x"))
            leads = leads.select("key", "x.lead", "x.of")
            meeting = rest.join(leads, "key").filter("component <> of").select(F.col("lead").alias("x"), F.col("member").alias("y"))
            rest = rest.join(leads.select("key", F.col("lead").alias("member")), ["key", "member"], "left_anti").select("key", "member")
        else:
            rare = _rarest(stage(rest.select("member", "component").distinct(), "llm-members"), sets, percent)
            meeting = _rare_meetings(stage(rare, "llm-rarest"), sums, percent)
        fresh = stage(pairs(meeting, "x", "y").join(met, ["a", "b"], "left_anti"), "llm-pairs")
        rest = stage(rest.select("key", "member"), "llm-open")
        met = met.union(fresh)  # pairs that the sketches rule out may be met, and ruled out, again
        more = stage(_verified(fresh, sets, percent), "llm-links")
        if more.limit(1).count():
            edges = edges.union(more)
            found = components(edges)

    whole = classes.join(found.toDF("rep", "component"), "rep", "left")
    whole = whole.select("n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    labelled = sums.join(whole, ["n", "d1", "d2"], "left").withColumn("component", F.coalesce("component", ROW))
    names = sums.select(F.col(ROW).alias("component"), F.col("doc_id").alias("component_id"))
    return labelled.join(names, "component").select(
        ROW, "doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("component") == F.col(ROW)).alias("first")
    )
