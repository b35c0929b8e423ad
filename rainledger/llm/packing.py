"""Best-fit packing of documents into token sequences, with certified bin counts.

Documents are tokenised in tasks, cut to pieces, and dealt to partitions of about ``PART_PIECES`` pieces. Each partition
packs its pieces by best-fit decreasing and compares its bins with lower bounds from dual feasible functions. Where
the two are equal the packing is optimal, and final. The other partitions exchange documents: their bins with a gap are
dealt out again, whole bins from many partitions to each new group, and every group reruns best-fit
decreasing on its documents, keeping its former bins unless the rerun needs fewer.

Null texts are empty documents: the end token alone. Rows that repeat an id, or have none, are documents of their own
(see ``rows``). Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.staging import stage
from . import grams
from .byte_tokens import byte_tokens
from .rows import ROW, identified

PART_PIECES = 50_000
EXCHANGES = 2
PIECES = f"{ROW} long, doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long, gap boolean"


def token_pieces(docs: DataFrame, tokenizer: str, ranks: str, limit: int, end: int, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: a shorter first one, then whole ones of ``limit`` tokens."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(tokenizer, ranks)
        tail = np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            for part in grams.slices(batch, "text"):
                rows = []
                encoded = tokens.encode([text or "" for text in part.column("text").to_pylist()])
                for row, doc, ids in zip(part.column(ROW).to_pylist(), part.column("doc_id").to_pylist(), encoded):
                    ids += tail
                    total = len(ids) // 4
                    start, piece = 0, 0
                    while start < total:
                        length = (total % limit or limit) if start == 0 else limit
                        own = ids[4 * start : 4 * (start + length)]
                        rows.append((row, doc, piece, start, length, zlib.crc32(own), *([own] if keep_ids else [])))
                        start, piece = start + length, piece + 1
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.binary()] if keep_ids else [])]
                names = [ROW, "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.mapInArrow(read, PIECES + (", ids binary" if keep_ids else ""))


def lower_bound(sizes: np.ndarray, limit: int) -> int:
    """Bins that any packing needs: the best of several dual feasible functions, in exact integers.

    For each threshold t, sizes above ``limit - t`` count whole, those below t nothing; for each k, the k-fold
    rounding of Fekete and Schepers counts what fits k + 1 times.
    """
    counts = np.bincount(sizes, minlength=limit + 1).astype(np.int64)
    values = np.arange(limit + 1, dtype=np.int64)
    best = -(-int((counts * values).sum()) // limit)
    many, mass = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * values)])
    for t in range(1, limit // 2 + 1):
        large = many[-1] - many[limit - t + 1]
        middle = mass[limit - t + 1] - mass[t]
        best = max(best, int(large) + -(-int(middle) // limit))
    for k in range(1, 21):
        whole = (k + 1) * values % limit == 0
        # In units of 1 / (k * limit): x when (k + 1) x / limit is whole, else floor((k + 1) x / limit) / k.
        weight = np.where(whole, k * values, (k + 1) * values // limit * limit)
        best = max(best, -(-int((counts * weight).sum()) // (k * limit)))
    return best


def best_fit_decreasing(sizes: np.ndarray, limit: int) -> np.ndarray:
    """The bin of each size, for sizes in falling order: the fullest open bin that has room."""
    bins = np.empty(len(sizes), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    open_rooms, used = 0, 0
    for i, size in enumerate(sizes.tolist()):
        roomy = open_rooms >> size
        if roomy:
            room = size + (roomy & -roomy).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, own = limit, used
            used += 1
        bins[i] = own
        if room > size:
            by_room[room - size].append(own)
            open_rooms |= 1 << (room - size)
    return bins


def _packed(limit: int, round_: int):
    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", ROW, "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        sizes = part["length"].to_numpy()
        bins = best_fit_decreasing(sizes, limit)
        count = int(bins.max()) + 1
        if round_ == 0 or count < part["sequence_id"].nunique():
            part["sequence_id"] = (round_ << 58) | (int(key[0]) << 32) | bins
        part = part.sort_values(["sequence_id", "length", ROW, "piece"], ascending=[True, False, True, True], kind="stable", ignore_index=True)
        by = part.groupby("sequence_id")["length"]
        part["offset"] = by.cumsum() - part["length"]
        certified = part["sequence_id"].nunique() == lower_bound(sizes, limit)
        part["gap"] = (by.transform("sum") < limit) & (not certified)
        return part.drop(columns="part")

    return pack


def pack_documents(
    docs: DataFrame, tokenizer: str, ranks: str, limit: int = 1024, end: int = 2, keep_ids: bool = False
) -> DataFrame:
    """Every piece with its sequence and its offset there; ``keep_ids`` adds the piece's ids (little-endian, 32 bits).

    ``tokenizer`` and ``ranks`` are the two files of one byte-level vocabulary.
    """
    pieces = stage(token_pieces(identified(docs), tokenizer, ranks, limit, end, keep_ids), "llm-pieces")
    schema = PACKED.replace(", sequence_id", ", ids binary, sequence_id") if keep_ids else PACKED

    def dealt(rows: DataFrame, count: int, *by: str) -> DataFrame:
        return rows.withColumn("part", F.pmod(F.xxhash64(*by), F.lit(max(1, -(-count // PART_PIECES)))))

    def run(rows: DataFrame, round_: int) -> DataFrame:
        return rows.groupBy("part").applyInPandas(_packed(limit, round_), schema)

    fresh = pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long"), "gap": F.lit(True)})
    packed = stage(run(dealt(fresh, pieces.count(), ROW, "piece"), 0), "llm-packed")
    final = packed.filter(~F.col("gap"))
    for round_ in range(1, EXCHANGES + 1):
        open_ = packed.filter("gap")
        count = open_.count()
        if not count:
            return final
        packed = stage(run(dealt(open_, count, "sequence_id", F.lit(round_)), round_), "llm-packed")
        final = final.union(packed.filter(~F.col("gap")))
    return final.union(packed.filter("gap"))
