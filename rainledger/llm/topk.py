"""Exact top-k by inner product: distributed histogram selection over integer vectors.

Queries meet all vectors in blocks of bounded size. Every pass scores everything again and keeps only counts: the
first covers the whole range of scores, each later one the bin that holds a query's k-th score, until a bin is one
score wide. The last pass returns what lies above that score, and of the rows that tie with it the smallest ids needed.

Components become ``floor(scale * x)``, x as double. Vectors that are null, or hold a null or non-finite component, take no
part; neither do rows without an id, which could not be named. Vectors of unlike length have no score. Rows
that repeat an id are rows of their own, in the order of their vectors; each that is a query is answered, and a row is never its own
partner. Scores must fit a long: larger ones raise an error. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.staging import stage
from .rows import ROW, identified

QUERY_BLOCK, VECTOR_BLOCK, BINS = 1024, 4096, 256
_KEYS = ["dim", "query_block", "vector_block"]


def _whole_numbers(scale: int):
    def read(batches):
        for batch in batches:
            vectors = batch.column("vector")
            values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if len(values) and np.abs(values).max() >= 2.0**62:
                raise ValueError("a component does not fit a long")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            whole = values.astype(np.int64)
            packed = [whole[e - n : e].tobytes() for e, n in zip(ends, lengths)]
            norm = [float((values[e - n : e] ** 2).sum()) for e, n in zip(ends, lengths)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), batch.column("vec_id"), pa.array(lengths), pa.array(packed, pa.binary()), pa.array(norm, pa.float64())],
                names=[ROW, "vec_id", "dim", "packed", "norm"],
            )

    return read


def _matrix(rows: pa.Table) -> np.ndarray:
    """All rows of a group have one length, 0 included; a side of the group may be empty."""
    data = b"".join(rows.column("packed").to_pylist())
    dim = rows.column("dim")[0].as_py() if rows.num_rows else 0
    return np.frombuffer(data, dtype=np.int64).reshape(rows.num_rows, dim)


def _scores(queries: pa.Table, vectors: pa.Table):
    """Scores of each query with all vectors of the block in turn; a row's score with itself is left out."""
    if not queries.num_rows or not vectors.num_rows:
        return  # a length that only queries, or only vectors of this block, have
    left, right = _matrix(queries), _matrix(vectors)
    peak = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if peak < 2.0**53:
        left, right = left.astype(np.float64), right.astype(np.float64)
    elif peak >= 2.0**63:
        left, right = left.astype(object), right.astype(object)
    right = np.ascontiguousarray(right.T)
    ids = vectors.column(ROW).to_numpy()
    own = queries.column(ROW).to_numpy()
    for first in range(0, len(own), 64):
        block = left[first : first + 64] @ right
        if block.dtype == object and block.size and max(abs(int(block.max())), abs(int(block.min()))) >= 1 << 63:
            raise ValueError("a score does not fit a long")
        block = block.astype(np.int64)
        for i, scores in enumerate(block):
            others = ids != own[first + i]
            yield first + i, scores[others], ids[others]


def _counts(k: int):
    """Counts of a block's scores by bin: from the top to the bin that holds the block's own k-th score."""

    def count(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        lows, widths, tops = (queries.column(c).to_numpy() for c in ("low", "width", "bins"))
        rows, bins, counts = [], [], []
        ids = queries.column(ROW).to_numpy()
        for i, scores, _ in _scores(queries, vectors):
            offsets = scores - lows[i]
            offsets = offsets[(offsets >= 0) & (offsets < widths[i] * tops[i])] // widths[i]
            if not len(offsets):
                continue
            found = np.bincount(offsets, minlength=1)
            above = np.cumsum(found[::-1])[::-1]
            used = np.flatnonzero((found > 0) & (above - found < k))
            rows.append(np.full(len(used), ids[i]))
            bins.append(used)
            counts.append(found[used])
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
        return pa.table({ROW: join(rows), "bin": join(bins), "n": join(counts)})

    return count


def _chosen(queries: pa.Table, vectors: pa.Table) -> pa.Table:
    lows, ties = queries.column("low").to_numpy(), queries.column("need").to_numpy()
    ids = queries.column(ROW).to_numpy()
    parts = []
    for i, scores, others in _scores(queries, vectors):
        above = scores > lows[i]
        level = np.sort(others[scores == lows[i]])[: ties[i]]
        own = np.concatenate([others[above], level])
        values = np.concatenate([scores[above], np.full(len(level), lows[i])])
        parts.append((np.full(len(own), ids[i]), own, values))
    columns = [np.concatenate(c) if parts else np.zeros(0, dtype=np.int64) for c in (zip(*parts) if parts else [()] * 3)]
    return pa.table(dict(zip([ROW, "partner", "score"], columns)))


def top_partners(vectors: DataFrame, queries: str, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest scores of each row that meets ``queries``, an SQL
    condition on vec_id; equal scores by smaller id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = identified(vectors, "vec_id", "embedding").filter(F.col("vec_id").isNotNull())
    rows = rows.filter(F.col("embedding").isNotNull() & finite)
    rows = rows.select(ROW, "vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.mapInArrow(_whole_numbers(scale), f"{ROW} long, vec_id long, dim long, packed binary, norm double")
    rows = stage(rows, "llm-vectors")
    asked = rows.filter(queries)
    count, peak = rows.agg(F.count(F.lit(1)), F.max("norm")).first()
    limit = int(peak or 0) + 1  # no score is farther from 0
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    vector_blocks = max(1, -(-count // VECTOR_BLOCK))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = (
        rows.select(ROW, "dim", "packed", F.pmod(F.xxhash64(ROW), F.lit(vector_blocks)).cast("int").alias("vector_block"))
        .toDF(ROW, "dim", "packed", "vector_block")  # columns of its own, for the join with other rows of this table
        .withColumn("query_block", each(query_blocks))
        .groupBy(*_KEYS)
    )
    block = F.pmod(F.xxhash64(ROW, F.lit(1)), F.lit(query_blocks)).cast("int")
    heads = asked.select(ROW, "dim", "packed", block.alias("query_block"))

    def against_all(state: DataFrame, run, schema: str) -> DataFrame:
        """``run`` on every block of queries, with what is known of them, and every block of vectors."""
        dealt = heads.join(state, ROW).withColumn("vector_block", each(vector_blocks)).groupBy(*_KEYS)
        return dealt.cogroup(blocks).applyInArrow(run, schema)

    width = -(-(2 * limit + 1) // BINS)
    state = asked.select(
        ROW, F.lit(-limit).alias("low"), F.lit(width).cast("long").alias("width"), F.lit(BINS).alias("bins"), F.lit(k).cast("long").alias("need")
    )
    down = Window.partitionBy(ROW).orderBy(F.desc("bin"))
    while True:
        counts = against_all(state, _counts(k), f"{ROW} long, bin long, n long").groupBy(ROW, "bin").agg(F.sum("n").alias("n"))
        reached = counts.withColumn("upto", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        # The highest bin by which the k-th score is reached; with fewer scores in all, the lowest bin.
        at = reached.join(state.select(ROW, "low", "width", "need"), ROW).groupBy(ROW).agg(
            F.max(F.when(F.col("upto") >= F.col("need"), F.struct("bin", "n", "upto"))).alias("hit"),
            F.min(F.struct("bin", "n", "upto")).alias("last"),
            F.first("low").alias("low"),
            F.first("need").alias("need"),
        )
        found = F.coalesce("hit", "last")
        finer = -(-width // BINS)
        state = stage(
            at.select(
                ROW,
                (F.col("low") + found["bin"] * width).alias("low"),
                F.lit(finer).cast("long").alias("width"),
                F.lit(-(-width // finer)).alias("bins"),
                (F.col("need") - (found["upto"] - found["n"])).alias("need"),
            ),
            "llm-thresholds",
        )
        if width == 1:
            break
        width = finer
    chosen = against_all(state, _chosen, f"{ROW} long, partner long, score long")
    best = Window.partitionBy(ROW).orderBy(F.desc("score"), "partner")
    ranked = chosen.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    names = rows.select(F.col(ROW).alias("partner"), "vec_id")
    return (
        ranked.join(names, "partner")
        .join(asked.select(ROW, F.col("vec_id").alias("query_id")), ROW)
        .select("query_id", "rank", "vec_id", "score")
    )
