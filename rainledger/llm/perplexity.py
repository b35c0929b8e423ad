"""Quality rules: text statistics, and n-gram perplexity under a model per language.

The model is modified Kneser-Ney of order 5 over UTF-8 bytes. Spark counts the n-grams of all documents, every one of them, and
derives continuation counts, discounts and back-off weights by grouping and joining; a context or a suffix has 256 n-grams at most,
so no key of these joins is hot. Every language has models and bands of its own, and null is a language too. A language's
documents are dealt into ``FOLDS`` folds by a hash of the text, so copies are in one. ``perplexity`` goes by the counts of all of them,
``held_out_perplexity`` by those of the other folds: a text says nothing for itself, and unseen n-grams back off to shorter ones.

The number of entries grows with the corpus. They are dealt by hash into shards of about ``SHARD_ENTRIES``; each shard is one pair
of sorted arrays (key, cost), broadcast by itself, and the documents are read once for each shard, which adds what it knows. So
a task holds one shard, however large the models are. Entries only add up, so it doesn't matter which shard has which.

A document is kept if it has at least 50 words, at most half of them in repeated 3-word windows, and a held-out perplexity
within its language's bands. The bands are the outer fences (quartiles -+ ``FENCE`` times their distance, and ``SLACK`` bits) of the
documents that pass the first two rules. All sums are whole numbers, so results don't depend on how rows are dealt.

Null texts are empty: no words, not kept. Texts of fewer than 5 bytes have no n-gram, and perplexity null. Rows that
repeat an id, or have none, are rated each by itself. Other columns pass through or are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.staging import stage
from . import grams
from .rows import ROW, carried, identified, restored

ORDER, BITS, FOLDS = 5, 8, 2
#: N-grams in one broadcast (12 bytes each), and in a counting task before it passes them on.
SHARD_ENTRIES, HELD_ENTRIES = 1 << 22, 1 << 21
FENCE, SLACK, BAND_STEPS = 3, 0.05, 256
#: Log probabilities are whole numbers of 2**-16 bits.
UNIT = 1 << 16
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _codes(data: np.ndarray) -> np.ndarray:
    """The n-gram that begins at each byte, as far as there is one."""
    n = max(0, len(data) - ORDER + 1)
    codes = np.zeros(n, dtype=np.int64)
    for i in range(ORDER):
        codes = (codes << BITS) | data[i : n + i]
    return codes


def _keys(batch: pa.RecordBatch, languages: list[str]) -> Iterator[tuple[grams.Chunk, np.ndarray, np.ndarray]]:
    """Each chunk of a batch (ROW, text, lang, fold), where its n-grams begin, and their codes with language and fold before
    them. Without folds all documents are in the first."""
    own, at = _models(batch.column("lang"), languages) * FOLDS, 0
    if "fold" in batch.schema.names:
        own = own + batch.column("fold").to_numpy()
    for chunk in grams.chunks(batch, ROW, "text"):
        model = np.repeat(own[at : at + len(chunk.ids)], np.diff(chunk.bounds))
        at += len(chunk.ids)
        begins = np.flatnonzero(grams.starts_within(chunk.bounds, ORDER))
        yield chunk, begins, (model[begins].astype(np.int64) << (ORDER * BITS)) | _codes(chunk.data)[begins]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    counts = np.concatenate([c for _, c in parts])[order]
    del order
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = keys[1:] != keys[:-1]
    return keys[fresh], np.add.reduceat(counts, np.flatnonzero(fresh)) if len(keys) else counts


def _count(languages: list[str]):
    def out(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, counts = _summed(parts)
        for first in range(0, len(keys), 1 << 17):
            own = keys[first : first + (1 << 17)]
            columns = [(own >> (ORDER * BITS)).astype(np.int32), own & ((1 << (ORDER * BITS)) - 1), counts[first : first + (1 << 17)]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["model", "code", "n"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for _, _, keys in _keys(batch, languages):
                parts.append(np.unique(keys, return_counts=True))
                held += len(parts[-1][0])
                if held > HELD_ENTRIES:
                    parts = [_summed(parts)]
                    held = len(parts[0][0])
                    if 2 * held > HELD_ENTRIES:
                        yield from out(parts)
                        parts, held = [], 0
        if parts:
            yield from out(parts)

    return read


def _models(column: pa.Array, languages: list[str]) -> np.ndarray:
    """The place of each row's language; null comes after all others."""
    place = pa.compute.index_in(column.cast(pa.string()), value_set=pa.array(languages, pa.string()))
    return place.fill_null(len(languages)).to_numpy(zero_copy_only=False)


def all_languages(docs: DataFrame) -> list[str]:
    found = sorted(r["lang"] for r in docs.filter(F.col("lang").isNotNull()).select("lang").distinct().collect())
    if (len(found) + 1) * (FOLDS + 1) > 1 << (61 - ORDER * BITS):
        raise ValueError(f"{len(found)} languages: keys have no room for so many models")
    return found


def _cost_of(p: Column) -> Column:
    """Minus log2 of a probability in units."""
    return F.round(-F.log2(F.greatest(p, F.lit(1e-12))) * UNIT).cast("int")


def _entry(model, context: int, size: int, code):
    """The key of an n-gram of up to ``ORDER`` bytes, or of a context, in a model: a one before the code tells the size."""
    return (model << (ORDER * BITS + 2)) | (context << (ORDER * BITS + 1)) | (1 << (size * BITS)) | code


def train(docs: DataFrame, languages: list[str]) -> DataFrame:
    """key, cost: the entries of each language's models of the documents (ROW, text, lang, fold), all orders interpolated.

    Each language has ``FOLDS + 1`` models. The first counts all its documents, and has what the last byte of each n-gram of
    ``ORDER`` bytes costs after the others. Model ``1 + f`` counts those outside of fold f. It has, of every size, what a context costs on
    the way to the next shorter one, and what an n-gram costs more (or less) than that way: a byte costs BITS, and the sum of
    all entries found for it.
    """
    counted = docs.mapInArrow(_count(languages), "model int, code long, n long")
    outside = F.explode(F.expr(f"filter(sequence(0, {FOLDS}), v -> v <> 1 + model % {FOLDS})"))
    counted = counted.select(F.expr(f"model DIV {FOLDS} * {FOLDS + 1}").alias("first"), outside.alias("v"), "code", "n")
    counted = counted.select((F.col("first") + F.col("v")).cast("int").alias("model"), "code", "n")
    entries, held_out = [], F.col("model") % (FOLDS + 1) > 0

    def entry(context: int, size: int, code: str) -> Column:
        key = F.shiftleft(F.col("model").cast("long"), ORDER * BITS + 2).bitwiseOR(F.col(code))
        return key.bitwiseOR(F.lit(_entry(0, context, size, 0)).cast("long")).alias("key")

    counts = {ORDER: stage(counted.groupBy("model", "code").agg(F.sum("n").alias("n")), "llm-ngrams")}
    for size in range(ORDER - 1, 0, -1):
        ending = F.col("code").bitwiseAND((1 << (size * BITS)) - 1).alias("code")
        # How many different bytes stand before it: Kneser-Ney's counts of the lower orders.
        counts[size] = stage(counts[size + 1].groupBy("model", ending).agg(F.count(F.lit(1)).alias("n")), "llm-ngrams")
    lower = None
    for size in range(1, ORDER + 1):
        own = counts[size]
        seen = own.groupBy("model").agg(*[F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.col("n1") / F.nullif(F.col("n1") + 2 * F.col("n2"), F.lit(0))
        discount = [
            F.coalesce(F.greatest(F.lit(0.0), F.lit(float(i)) - (i + 1) * y * F.col(f"n{i + 1}") / F.nullif(F.col(f"n{i}"), F.lit(0))), F.lit(0.5)).alias(f"d{i}")
            for i in (1, 2, 3)
        ]
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = own.join(seen.select("model", *discount), "model").select("model", "code", F.shiftright("code", BITS).alias("context"), "n", cut.alias("d"))
        # Whole counts of each discount, so that the sums are exact.
        share = own.groupBy("model", F.shiftright("code", BITS).alias("context")).agg(
            F.sum("n").alias("all"), *[F.sum((F.col("n") == i).cast("long")).alias(f"c{i}") for i in (1, 2)], F.sum((F.col("n") > 2).cast("long")).alias("c3")
        )
        share = share.join(seen.select("model", *discount), "model")
        gamma = (F.col("c1") * F.col("d1") + F.col("c2") * F.col("d2") + F.col("c3") * F.col("d3")) / F.col("all")
        share = stage(share.select("model", "context", "all", gamma.alias("gamma")), "llm-contexts")
        entries.append(share.filter(held_out).select(entry(1, size - 1, "context"), _cost_of(F.col("gamma")).alias("cost")))
        rows = rows.join(share, ["model", "context"])
        if lower is None:
            rows = rows.withColumn("p_below", F.lit(1.0 / (1 << BITS)))
        else:
            below = F.col("code").bitwiseAND((1 << ((size - 1) * BITS)) - 1)
            rows = rows.withColumn("below", below).join(lower.toDF("model", "below", "p_below"), ["model", "below"])
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("all") + F.col("gamma") * F.col("p_below")
        lower = stage(rows.select("model", "code", p.alias("p"), "gamma", "p_below"), "llm-probabilities")
        whole = _cost_of(F.col("p"))
        more = whole - _cost_of(F.col("gamma")) - _cost_of(F.col("p_below"))
        own = lower if size == ORDER else lower.filter(held_out)
        entries.append(own.select(entry(0, size, "code"), F.when(held_out, more).otherwise(whole).alias("cost")))
        lower = lower.select("model", "code", "p")
    return reduce(DataFrame.union, entries)


def sorted_shards(known: DataFrame, entries: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and their costs: shards of about ``entries``."""
    shards = max(1, -(-known.count() // entries))
    for i in range(shards):
        rows = known.filter(F.pmod(F.xxhash64("key"), F.lit(shards)) == i).toArrow()
        # One copy at a time, so that the driver holds little more than one shard.
        keys = rows.column("key").to_numpy()
        costs = rows.column("cost").to_numpy().astype(np.int32, copy=False)
        del rows
        order = np.argsort(keys).astype(np.int32)
        keys = keys[order]
        yield keys, costs[order]
        del keys, costs, order


def _found(source: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """What one shard has for each key, or 0."""
    known, costs = source
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, costs[at], 0).astype(np.int64)


def _backed_off(source: tuple[np.ndarray, np.ndarray], model: np.ndarray, code: np.ndarray, size: int = ORDER) -> np.ndarray:
    """What one shard has for the last byte of each n-gram and for all its contexts."""
    cost = _found(source, _entry(model, 0, size, code)) + _found(source, _entry(model, 1, size - 1, code >> BITS))
    if size > 1:
        shorter = (model << (ORDER * BITS)) | (code & ((1 << ((size - 1) * BITS)) - 1))
        below, place = np.unique(shorter, return_inverse=True)
        cost += _backed_off(source, below >> (ORDER * BITS), below & ((1 << (ORDER * BITS)) - 1), size - 1)[place]
    return cost


def _cost(languages: list[str], source: Broadcast):
    """Of each document: what its n-grams in one shard cost, by all documents and by those outside of its fold."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, begins, keys in _keys(batch, languages):
                each = np.zeros((2, len(chunk.data)), dtype=np.int64)
                asked, place = np.unique(keys, return_inverse=True)
                own, code = asked >> (ORDER * BITS), asked & ((1 << (ORDER * BITS)) - 1)
                first = own // FOLDS * (FOLDS + 1)
                each[0, begins] = _found(source.value, _entry(first, 0, ORDER, code))[place]
                each[1, begins] = _backed_off(source.value, first + 1 + own % FOLDS, code)[place]
                sums = [pa.array(_per_doc(x, chunk.bounds)) for x in each]
                yield pa.RecordBatch.from_arrays([pa.array(chunk.ids), *sums], names=[ROW, "cost", "held_out"])

    return read


def _per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries occur twice or more in their document, and which of those are not its first."""
    keys = grams.mix(keys + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 21)
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys), dtype=bool)
    same[1:] = keys[order[1:]] == keys[order[:-1]]
    later, twice = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    later[order] = same
    both = same.copy()
    both[:-1] |= same[1:]
    twice[order] = both
    return twice, later


def _lines(chunk: grams.Chunk) -> np.ndarray:
    """For each document: lines with a word that equal an earlier line of it."""
    breaks = np.flatnonzero(chunk.data == 10)
    starts = np.unique(np.concatenate([chunk.bounds[:-1], breaks + 1]))
    starts = starts[starts < len(chunk.data)]
    doc = np.searchsorted(chunk.bounds, starts, side="right") - 1
    following = np.append(starts[1:], len(chunk.data))
    ends = following - (chunk.data[following - 1] == 10)
    word = np.concatenate([[0], np.cumsum(~grams.is_separator(chunk.data))])
    some = word[ends] > word[starts]
    starts, ends, doc = starts[some], ends[some], doc[some]
    later = _repeated(grams.byte_ranges(chunk.data, starts, ends), doc)[1]
    return np.bincount(doc[later], minlength=len(chunk.ids))


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _statistics(chunk: grams.Chunk) -> list[np.ndarray]:
    words = grams.words(chunk)
    letters = ~grams.is_separator(chunk.data) & ((chunk.data & 0xC0) != 0x80)
    repeated = np.zeros(len(words.starts), dtype=np.int64)
    begins = np.flatnonzero(grams.starts_within(words.bounds, 3))
    if len(begins):
        doc = np.searchsorted(words.bounds, begins, side="right") - 1
        twice = begins[_repeated(grams.RangeHashes(words.hashes).of(begins, begins + 3), doc)[0]]
        for i in range(3):
            repeated[twice + i] = 1
    return [
        np.diff(words.bounds),
        _per_doc(letters, chunk.bounds),
        _per_doc(_SYMBOLS[chunk.data], chunk.bounds),
        _lines(chunk),
        _per_doc(repeated, words.bounds),
    ]


def _measure(languages: list[str]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, at = _models(batch.column("lang"), languages), 0
            for chunk in grams.chunks(batch, ROW, "text"):
                n_grams = np.maximum(np.diff(chunk.bounds) - ORDER + 1, 0)
                found = [chunk.ids, *_statistics(chunk), own[at : at + len(chunk.ids)], n_grams]
                at += len(chunk.ids)
                yield pa.RecordBatch.from_arrays([*map(pa.array, found)], names=[ROW, *STATS, "model", "n_grams"])

    return read


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bits(cost: str = "cost") -> Column:
    """Mean bits of a byte; null without n-grams."""
    return F.col(cost) / F.nullif(F.col("n_grams"), F.lit(0)) / UNIT


def bands(rated: DataFrame) -> DataFrame:
    """model, low, high: the lowest and highest mean bits allowed."""
    passed = rated.filter(~base_failed() & (F.col("n_grams") > 0))
    counts = passed.groupBy("model", F.floor(bits("held_out") * BAND_STEPS).alias("step")).count()
    by = Window.partitionBy("model").orderBy("step")
    share = F.sum("count").over(by) / F.sum("count").over(Window.partitionBy("model"))
    quarter = lambda q: F.min(F.when(F.col("share") >= q, F.col("step"))) / BAND_STEPS
    rows = counts.withColumn("share", share).groupBy("model").agg(quarter(0.25).alias("q1"), quarter(0.75).alias("q3"))
    reach = FENCE * (F.col("q3") - F.col("q1")) + SLACK
    return rows.select("model", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))


def _rated(docs: DataFrame, entries: int) -> DataFrame:
    """ROW, the statistics, base_failed, perplexity and kept of documents (ROW, text, lang)."""
    languages, context = all_languages(docs), docs.sparkSession.sparkContext
    # Equal texts are in one fold.
    docs = docs.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))
    costs = None
    for shard in sorted_shards(stage(train(docs, languages), "llm-model"), entries):
        source = context.broadcast(shard)
        del shard
        known = stage(docs.mapInArrow(_cost(languages, source), f"{ROW} long, cost long, held_out long"), "llm-costs")
        source.destroy()
        costs = known if costs is None else stage(costs.union(known).groupBy(ROW).agg(F.sum("cost").alias("cost"), F.sum("held_out").alias("held_out")), "llm-costs")
    kinds = ", ".join(f"{c} long" for c in STATS)
    measured = docs.mapInArrow(_measure(languages), f"{ROW} long, {kinds}, model int, n_grams long")
    held_out = F.col("held_out") + F.col("n_grams") * (BITS * UNIT)
    rated = stage(measured.join(costs, ROW).withColumn("held_out", held_out), "llm-rated")
    inside = bits("held_out").between(F.col("low"), F.col("high"))
    return rated.join(F.broadcast(bands(rated)), "model", "left").select(
        ROW,
        *STATS,
        base_failed().alias("base_failed"),
        F.pow(F.lit(2.0), bits()).alias("perplexity"),
        F.pow(F.lit(2.0), bits("held_out")).alias("held_out_perplexity"),
        F.coalesce(~base_failed() & inside, F.lit(False)).alias("kept"),
    )


def rate_documents(docs: DataFrame, entries: int = SHARD_ENTRIES) -> DataFrame:
    """doc_id, the statistics, base_failed, perplexity (of a byte) and kept, for every document."""
    rows = identified(docs, "doc_id", "text", "lang")
    rated = _rated(rows.select(ROW, "text", "lang"), entries)
    return rows.select(ROW, "doc_id").join(rated, ROW).drop(ROW)


def keep_good(docs: DataFrame, entries: int = SHARD_ENTRIES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    rows = carried(docs)
    good = _rated(rows.select(ROW, "text", F.col("_rest.lang").alias("lang")), entries).filter("kept").select(ROW)
    return restored(rows.join(good, ROW, "left_semi"), docs)
