"""Substring removal by suffix automata of reference shards.

The corpus is its own reference, so a broadcast of all shards would grow with the data and every
document would meet every shard. Instead ``repeats`` finds, by one sort, the segments that can repeat at all;
equal segments are settled there, and the contested ones are routed to shards of bounded size by their anchor. Each shard
builds one generalised suffix automaton of its reference segments, with the least document id of
every state, and streams the same segments for matching statistics: where at least ``window`` words match text
of an earlier document, the maximal span goes.

An anchor with more than ``ROUTE_LIMIT`` contested segments (a common line with ever new
neighbours) would outgrow a shard. Its windows are compared by a sort of their 128-bit names instead, which has no limit.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null texts have none; texts shorter than the window lose nothing.
Only repeats of a document with a smaller id count, so a document that repeats itself stays whole. Rows
that repeat an id, or have none, are documents of their own (see ``rows``). Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks.staging import stage
from . import grams, repeats
from .rows import ROW, carried, identified, restored

GRAM = 5
ROUTE_LIMIT = 2000
SHARD_SEGMENTS = 4000
RANGES = f"{ROW} long, start long, stop long"


class SuffixAutomaton:
    """All substrings of some word sequences; each state knows the least document id it occurs in."""

    def __init__(self) -> None:
        self.steps: list[dict[str, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [np.iinfo(np.int64).max]

    def _state(self, steps: dict[str, int], link: int, length: int, doc: int) -> int:
        self.steps.append(steps)
        self.link.append(link)
        self.length.append(length)
        self.least.append(doc)
        return len(self.link) - 1

    def _split(self, at: int, word: str, doc: int) -> int:
        """The state reached from ``at`` whose longest string ends exactly there; copied if it is longer."""
        to = self.steps[at][word]
        if self.length[to] == self.length[at] + 1:
            return to
        copy = self._state(dict(self.steps[to]), self.link[to], self.length[at] + 1, self.least[to])
        self.link[to] = copy
        while at >= 0 and self.steps[at].get(word) == to:
            self.steps[at][word] = copy
            at = self.link[at]
        return copy

    def add(self, words: list[str], doc: int) -> None:
        last = 0
        for word in words:
            if word in self.steps[last]:
                last = self._split(last, word, doc)
                self.least[last] = min(self.least[last], doc)
                continue
            new = self._state({}, 0, self.length[last] + 1, doc)
            at = last
            while at >= 0 and word not in self.steps[at]:
                self.steps[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word, doc)
            last = new

    def finish(self) -> None:
        """A state also occurs wherever a state that links to it does."""
        for state in np.argsort(self.length, kind="stable")[:0:-1].tolist():
            up = self.link[state]
            self.least[up] = min(self.least[up], self.least[state])

    def earlier_spans(self, words: list[str], doc: int, window: int) -> list[tuple[int, int]]:
        """Maximal spans of windows whose words also start in a document before ``doc``."""
        state, matched, spans = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in self.steps[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.steps[state]:
                state, matched = self.steps[state][word], matched + 1
            if matched < window:
                continue
            shortest = state
            while self.length[self.link[shortest]] >= window:
                shortest = self.link[shortest]
            if self.least[shortest] < doc:
                if spans and spans[-1][1] >= i + 1 - window:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((i + 1 - window, i + 1))
        return spans


def _segments(window: int):
    def find(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
        for chunk in grams.chunks(batch, ROW, "text"):
            words = grams.words(chunk)
            codes = grams.RangeHashes(words.hashes)
            found = grams.anchors(codes, words.bounds, window, GRAM)
            if not len(found.at):
                continue
            doc = np.searchsorted(words.bounds, found.lows, side="right") - 1
            first = words.bounds[doc]
            seg = grams.mix(codes.of(found.lows, found.highs + window) + (found.at - found.lows).astype(np.uint64), 9)
            yield {
                "name": found.names.view(np.int64),
                "seg": seg.view(np.int64),
                ROW: chunk.ids[doc],
                "place": repeats.pack_place(found.lows - first, found.highs - first, found.at - first),
            }

    return find


def _routed(window: int):
    """Contested segments with their words, to be dealt out by their anchor's name."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, marks = repeats.list_arrays(batch.column("marks"), ["name", "place"])
            at = 0
            for chunk in grams.chunks(batch, ROW, "text"):
                n = len(chunk.ids)
                own = slice(offsets[at], offsets[at + n])
                place, name = marks["place"][own], marks["name"][own]
                doc = np.repeat(np.arange(n), np.diff(offsets[at : at + n + 1]))
                at += n
                words = grams.words(chunk)
                starts = place >> 16
                first = words.bounds[doc] + starts
                last = first + ((place >> 8) & 255) + window - 1
                data = chunk.data.tobytes()
                texts = [data[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[last].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name), pa.array(chunk.ids[doc]), pa.array(starts), pa.array(texts, pa.binary())],
                    names=["name", ROW, "start", "words"],
                )

    return read


def _stream_shard(window: int):
    def read(shard: pa.Table) -> pa.Table:
        ids, starts = shard.column(ROW).to_pylist(), shard.column("start").to_pylist()
        segments = [text.split() for text in shard.column("words").to_pylist()]
        automaton = SuffixAutomaton()
        for doc, words in zip(ids, segments):
            automaton.add(words, doc)
        automaton.finish()
        rows = [
            (doc, start + a, start + b)
            for doc, start, words in zip(ids, starts, segments)
            for a, b in automaton.earlier_spans(words, doc, window)
        ]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=[ROW, "start", "stop"])

    return read


def _windows(window: int):
    """Every window of the contested segments of crowded anchors, under a 128-bit name."""

    def find(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
        offsets, marks = repeats.list_arrays(batch.column("marks"), ["name", "place"])
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
            names = []
            for family in (0, 1):
                words = grams.words(chunk, family=family)
                begin = words.bounds[doc] + starts
                names.append(grams.RangeHashes(words.hashes, family).of(begin, begin + window).view(np.int64))
            yield {"name": names[0], "seg": names[1], ROW: chunk.ids[doc], "place": starts << 16}

    return find


def _cut(text: bytes, starts: list[int], ends: list[int], gone: list[list[int]]) -> bytes:
    """A text without some runs of its words: each goes with the white space after it, the last of the text with the one before."""
    parts, at = [], 0
    for first, last in gone:
        if last < len(starts):
            cut, following = starts[first], starts[last]
        else:
            cut, following = (ends[first - 1] if first else starts[0]), ends[-1]
        parts.append(text[at:cut])
        at = following
    return b"".join([*parts, text[at:]])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, found = repeats.list_arrays(batch.column("ranges"), ["start", "stop"])
        at, kept, sizes, removed, spans = 0, [], [], [], []
        carried_on, missing = "_rest" in batch.schema.names, batch.column("text").is_null().to_pylist()
        for chunk in grams.chunks(batch, ROW, "text"):
            words = grams.words(chunk)
            data = chunk.data.tobytes()
            for i in range(len(chunk.ids)):
                own = slice(offsets[at], offsets[at + 1])
                at += 1
                first, last = words.bounds[i], words.bounds[i + 1]
                stay = ~grams.covered(last - first, found["start"][own], found["stop"][own])
                edges = np.flatnonzero(np.diff(np.concatenate([[0], (~stay).astype(np.int8), [0]]))).reshape(-1, 2).tolist()
                if carried_on:
                    own_text, shift = data[chunk.bounds[i] : chunk.bounds[i + 1]], chunk.bounds[i]
                    ranges = ((c[first:last] - shift).tolist() for c in (words.starts, words.ends))
                    kept.append(None if missing[at - 1] else _cut(own_text, *ranges, edges) if edges else own_text)
                else:
                    pairs = zip(words.starts[first:last][stay].tolist(), words.ends[first:last][stay].tolist())
                    kept.append(b" ".join([data[a:b] for a, b in pairs]))
                sizes.append(last - first)
                removed.append(int((~stay).sum()))
                spans.append([{"start": a, "stop": b} for a, b in edges])
        rest = [batch.column(c) for c in batch.schema.names if c == "_rest"]
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(ROW), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string()), *rest],
            names=[ROW, "doc_id", "n_words", "n_removed", "spans", "kept", *["_rest"][: len(rest)]],
        )


def remove_repeated_words(docs: DataFrame, window: int = 13) -> DataFrame:
    """Each document without the words of any ``window``-word passage that also starts in an earlier one.

    Returns doc_id, n_words, n_removed, the removed ``spans`` (word positions) and ``kept`` (the other words, joined
    by one space). Windows are judged on the input, not on what is left.
    """
    return _removed(identified(docs), window).drop(ROW)


def cut_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """The rows of ``docs`` with all their columns; the removed passages are cut out of ``text``.

    What stays keeps its line ends and spaces; a text without removals, null included, is the same as before.
    """
    return restored(_removed(carried(docs), window), docs, "kept")


def _removed(docs: DataFrame, window: int) -> DataFrame:
    if not GRAM < window <= GRAM + 200:
        raise ValueError(f"window must be in {GRAM + 1}..{GRAM + 200}")
    docs = docs.filter(F.col(ROW).isNotNull())
    first = repeats.settled_rows(docs.select(ROW, "text"), _segments(window), window, False)
    marks = stage(repeats.sort_and_settle(first, window, False), "llm-word-marks")
    contested = marks.filter("place >= 0").select(ROW, "name", "place")
    crowded = contested.groupBy("name").count().filter(F.col("count") > ROUTE_LIMIT).select("name")
    per_doc = F.collect_list(F.struct("name", "place")).alias("marks")
    plain = contested.join(crowded, "name", "left_anti").groupBy(ROW).agg(per_doc)
    hot = contested.join(crowded, "name", "left_semi").groupBy(ROW).agg(per_doc)

    segments = docs.join(plain, ROW).mapInArrow(_routed(window), f"name long, {ROW} long, start long, words binary")
    shards = max(1, -(-contested.count() // SHARD_SEGMENTS))
    streamed = (
        segments.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_stream_shard(window), RANGES)
    )
    windows = repeats.settled_rows(docs.join(hot, ROW), _windows(window), window, False)
    late = repeats.sort_and_settle(windows, window, False).filter("place < 0").select(ROW, "start", "stop")
    ranges = marks.filter("place < 0").select(ROW, "start", "stop").union(streamed).union(late)
    schema = f"{ROW} long, doc_id long, n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept string"
    if "_rest" in docs.columns:
        schema += f", _rest {docs.schema['_rest'].dataType.simpleString()}"
    return repeats.with_ranges(docs, ranges).mapInArrow(_remove, schema)
