"""Substring removal by distributed prefix doubling over UTF-8 bytes.

Positions are ranked by ever longer prefixes: 32 bytes at the sampled positions of ``repeats``, then
the whole segment around them, then, for what is still neither unique nor settled, the threshold itself as
the pair of the ranks of 64 bytes at a position and of the bytes after them (64 at least, so below 128 the two overlap). Spark sorts each round; positions that
are unique leave. A rank is a content's 64-bit name, so a pair needs no look-up at the offset; the last round compares
128 bits. Sorting every byte position in every round would move about 16 times the text each time;
the sampled positions find the same repeats (``tests/llm`` compares them with brute force).

Null texts are empty; texts shorter than the threshold lose nothing. Rows that repeat an id, or have none, are documents
of their own (see ``rows``). Equal documents: the first stays whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.staging import stage
from . import grams, repeats
from .rows import ROW, identified

GRAM = 32


def _segments(threshold: int):
    def find(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
        for chunk in grams.chunks(batch, ROW, "text"):
            codes = grams.RangeHashes.of_bytes(chunk.data)
            found = grams.anchors(codes, chunk.bounds, threshold, GRAM)
            if not len(found.at):
                continue
            doc = np.searchsorted(chunk.bounds, found.lows, side="right") - 1
            first = chunk.bounds[doc]
            seg = grams.mix(codes.of(found.lows, found.highs + threshold) + (found.at - found.lows).astype(np.uint64), 9)
            yield {
                "name": found.names.view(np.int64),
                "seg": seg.view(np.int64),
                ROW: chunk.ids[doc],
                "place": repeats.pack_place(found.lows - first, found.highs - first, found.at - first),
            }

    return find


def _contested_windows(threshold: int):
    """Every window of the contested segments, named by the ranks of its two parts, which have all of its bytes."""
    half = min(threshold, 2 * GRAM)

    def find(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
        offsets, marks = repeats.list_arrays(batch.column("marks"), ["place"])
        at = 0
        for chunk in grams.chunks(batch, ROW, "text"):
            n = len(chunk.ids)
            place = marks["place"][offsets[at] : offsets[at + n]]
            doc = np.repeat(np.arange(n), np.diff(offsets[at : at + n + 1]))
            at += n
            counts = ((place >> 8) & 255) + 1
            doc = np.repeat(doc, counts)
            inner = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            starts = np.repeat(place >> 16, counts) + inner
            codes = grams.RangeHashes.of_bytes(chunk.data)
            begin = chunk.bounds[doc] + starts
            late = begin + min(half, threshold - half)
            yield {
                "name": codes.of(begin, begin + half).view(np.int64),
                "seg": grams.mix(codes.of(late, begin + threshold), 13).view(np.int64),
                ROW: chunk.ids[doc],
                "place": starts << 16,
            }

    return find


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, found = repeats.list_arrays(batch.column("ranges"), ["start", "stop"])
        at, kept, removed, spans, sizes = 0, [], [], [], []
        for chunk in grams.chunks(batch, ROW, "text"):
            for i in range(len(chunk.ids)):
                data = chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]]
                own = slice(offsets[at], offsets[at + 1])
                at += 1
                gone = grams.covered(len(data), found["start"][own], found["stop"][own])
                kept.append(data[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                sizes.append(len(data))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeated_bytes(docs: DataFrame, threshold: int = 100) -> DataFrame:
    """Each document without the bytes of any ``threshold``-byte string that also starts earlier.

    Earlier: in a document of smaller id, or further left in the same one. Returns doc_id, n_bytes, n_removed, n_spans and
    ``kept`` (binary: a cut may fall inside a character).
    """
    if not GRAM < threshold <= GRAM + 255:
        raise ValueError(f"threshold must be in {GRAM + 1}..{GRAM + 255}")
    docs = identified(docs).filter(F.col(ROW).isNotNull())
    first = repeats.settled_rows(docs.select(ROW, "text"), _segments(threshold), threshold, True)
    marks = stage(repeats.sort_and_settle(first, threshold, True), "llm-byte-marks")
    contested = marks.filter("place >= 0").groupBy(ROW).agg(F.collect_list(F.struct("place")).alias("marks"))
    windows = repeats.settled_rows(docs.join(contested, ROW), _contested_windows(threshold), threshold, True)
    late = repeats.sort_and_settle(windows, threshold, True).filter("place < 0")
    ranges = marks.filter("place < 0").select(ROW, "start", "stop").union(late.select(ROW, "start", "stop"))
    return repeats.with_ranges(docs, ranges).mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
