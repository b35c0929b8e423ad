"""Finding repeated fixed-length windows across all documents, shared by the two substring operators.

A window of ``size`` units (words or bytes) is looked up through its anchor: the n-gram of least hash in
it. One anchor owns a run of neighbouring windows, so about one row in ``(size - gram) / 2`` units is sorted
instead of one per unit, and none is lost: equal windows own anchors of one name at the same place.

A segment is all an anchor's windows together. Where two segments are equal, the earlier one wins
all of their windows. Only the first segments of names that still have unlike segments (and their copies in the same document,
where those don't count) are *contested*: their windows may repeat in part, and are compared one by one by the caller.

Each task settles what it can among its own rows before the shuffle, so a passage that a third of all
documents share reaches a sort as one row per batch. The sorted rows are read as a stream: no group is
ever held in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import ROW, partitions

#: name, seg: what is compared. place: start of the first window << 16 | windows beyond it << 8 | anchor - start;
#: a negative place marks a range that is already settled: it begins at seg and ends before -place.
ROWS = f"name long, seg long, {ROW} long, place long"
MARKS = f"{ROW} long, start long, stop long, name long, place long"
_FIELDS = ["name", "seg", ROW, "place"]


def pack_place(lows: np.ndarray, highs: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (lows << 16) | ((highs - lows) << 8) | (at - lows)


def table(columns: dict[str, np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(columns[n]).view(np.int64)) for n in names], names=names)


def _ranges(ids: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges of all windows of some segments, joined where they touch."""
    starts = place >> 16
    stops = starts + ((place >> 8) & 255) + size
    order = np.lexsort((starts, ids))
    ids, starts, stops = ids[order], starts[order], stops[order]
    if not len(ids):
        return ids, starts, stops
    fresh = np.ones(len(ids), dtype=bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (starts[1:] > stops[:-1])
    heads = np.flatnonzero(fresh)
    return ids[heads], starts[heads], stops[np.append(heads[1:], len(ids)) - 1]


def settle_batch(columns: dict[str, np.ndarray], size: int, within: bool) -> pa.RecordBatch:
    """A batch's own first segments as rows, and the ranges of the others as settled rows.

    ``within``: a repeat inside one document counts; otherwise only one in an earlier document.
    """
    order = np.lexsort([columns[n] for n in reversed(_FIELDS)])
    c = {n: columns[n][order] for n in _FIELDS}
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (c["name"][1:] == c["name"][:-1]) & (c["seg"][1:] == c["seg"][:-1])
    leads = np.maximum.accumulate(np.where(same, 0, np.arange(len(order)))) if len(order) else order
    beaten = same & (within | (c[ROW][leads] < c[ROW]))
    rest = ~beaten  # a copy in its leader's own document may still lose to another batch
    ids, starts, stops = _ranges(c[ROW][beaten], c["place"][beaten], size)
    spread = (ids * 0x9E3779B1 + starts * 0x85EBCA6B).astype(np.int64)
    joined = {
        "name": np.concatenate([c["name"][rest].view(np.int64), spread]),
        "seg": np.concatenate([c["seg"][rest].view(np.int64), starts]),
        ROW: np.concatenate([c[ROW][rest], ids]),
        "place": np.concatenate([c["place"][rest], -stops]),
    }
    return table(joined, _FIELDS)


class _Run:
    """The open name of a sorted stream: its last first-segment, and whether it had others before."""

    def __init__(self) -> None:
        self.row: dict[str, np.ndarray] | None = None
        self.many = False

    def read(self, c: dict[str, np.ndarray], size: int, within: bool) -> pa.RecordBatch:
        old = self.row is not None
        if old:
            c = {n: np.concatenate([self.row[n], c[n]]) for n in _FIELDS}
        n = len(c["name"])
        fresh_name, fresh = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        fresh_name[1:] = c["name"][1:] != c["name"][:-1]
        fresh[1:] = fresh_name[1:] | (c["seg"][1:] != c["seg"][:-1])
        leads = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        run = np.cumsum(fresh_name) - 1
        firsts = np.bincount(run[fresh])
        firsts[0] += old and self.many
        beaten = ~fresh & (within | (c[ROW][leads] < c[ROW]))
        contested = (fresh & (firsts[run] > 1)) | (~fresh & ~beaten)
        if old and self.many:
            contested[0] = False  # told before
        last = leads[-1]
        self.row = {k: c[k][last : last + 1].copy() for k in _FIELDS}
        self.many = bool(firsts[-1] > 1)
        ids, starts, stops = _ranges(c[ROW][beaten], c["place"][beaten], size)
        none = np.full(len(ids), -1, dtype=np.int64)
        flat = np.zeros(int(contested.sum()), dtype=np.int64)
        return table(
            {
                ROW: np.concatenate([ids, c[ROW][contested]]),
                "start": np.concatenate([starts, flat]),
                "stop": np.concatenate([stops, flat]),
                "name": np.concatenate([none, c["name"][contested]]),
                "place": np.concatenate([none, c["place"][contested]]),
            },
            [ROW, "start", "stop", "name", "place"],
        )


def sort_and_settle(rows: DataFrame, size: int, within: bool) -> DataFrame:
    """``MARKS``: ranges beaten by an earlier equal segment (place -1), and contested first segments."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run()
        for batch in batches:
            c = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in _FIELDS}
            done = c["place"] < 0
            if done.any():
                none = np.full(int(done.sum()), -1, dtype=np.int64)
                yield table(
                    {ROW: c[ROW][done], "start": c["seg"][done], "stop": -c["place"][done], "name": none, "place": none},
                    [ROW, "start", "stop", "name", "place"],
                )
                c = {n: c[n][~done] for n in _FIELDS}
            if len(c["name"]):
                yield run.read(c, size, within)

    dealt = rows.repartition(partitions(rows), "name").sortWithinPartitions(*_FIELDS)
    return dealt.mapInArrow(read, MARKS)


def settled_rows(docs: DataFrame, find: Callable, size: int, within: bool) -> DataFrame:
    """``ROWS`` of all documents. ``find`` gives the columns of a record batch's segments, in parts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(find(batch))
            if parts:
                whole = {n: np.concatenate([p[n] for p in parts]) for n in _FIELDS}
                yield settle_batch(whole, size, within)

    return docs.mapInArrow(read, ROWS)


def with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Every document beside the ranges found in it, as one list."""
    listed = ranges.groupBy(ROW).agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    return docs.join(listed, ROW, "left")


def list_arrays(column: pa.Array, fields: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The offsets and the fields of a column of struct lists, null lists being empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.array(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    values = column.flatten()
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return offsets, {f: values.field(f).to_numpy(zero_copy_only=False) for f in fields}
