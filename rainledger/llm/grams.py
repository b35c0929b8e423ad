"""Vectorised hashing of texts inside tasks: words, n-gram hashes, and the minimum hash of each window.

Texts are handled as the UTF-8 bytes of an Arrow batch, a part of it at a time, so a task's memory is
bounded by its longest document. Hashes are the same in every task and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Bytes that are hashed at a time, so that the arrays stay in a core's cache; and bytes of text that are tokenized at a time.
CHUNK_BYTES, SLICE_BYTES = 1 << 18, 1 << 20
_MASK = (1 << 64) - 1
#: Bits of a packed window value that hold a position; the rest order the hashes.
_POSITION_BITS = 28


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _join(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """The hash of two parts, in order: multiplications and shifts alternate, so no algebra of one of them holds."""
    x = left * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x += right * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64((salt * 0xD1B54A32D192ED03) & _MASK)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


#: Keeps the first bytes of a little-endian word.
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each position, as one integer; zeros follow the last."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))


def byte_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """The hash of each range of bytes, however long: eight bytes at a time, each mixed with its place, then summed."""
    sizes = ends - starts
    pieces = -(-sizes // 8)
    firsts = np.cumsum(pieces) - pieces
    total = int(pieces.sum())
    owner = np.repeat(np.arange(len(sizes)), pieces)
    inner = np.arange(total) - firsts[owner]
    at = starts[owner] + 8 * inner
    values = _eights(data)[at] & _FIRST_BYTES[np.minimum(ends[owner] - at, 8)]
    keyed = mix(values ^ mix(inner.astype(np.uint64), 60 + family), 62 + family)
    sums = np.zeros(len(sizes), dtype=np.uint64)
    some = pieces > 0
    if total:
        sums[some] = np.add.reduceat(keyed, firsts[some])
    return mix(sums + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 64 + family)


class RangeHashes:
    """Hashes of any ranges of a sequence of 64-bit codes, by doubling.

    Level k holds the hash of the ``2 ** k`` codes from each position on, made of two hashes of level k - 1. A range is hashed by
    the two longest of these that begin and end with it, which together cover all of it. Unlike texts share a hash by
    chance only (64 bits): there is no sum of powers whose terms could cancel.
    """

    def __init__(self, codes: np.ndarray, family: int = 0):
        self.count, self.first, self.levels, self.salt = len(codes), 0, [codes], 100 * family

    @classmethod
    def of_bytes(cls, data: np.ndarray, family: int = 0) -> RangeHashes:
        """Of ranges of eight bytes or more: eight bytes are one code, by themselves."""
        hashes = cls(data, family)
        hashes.first, hashes.levels = 3, [mix(_eights(data)[: max(0, len(data) - 7)], 66 + family)]
        return hashes

    def _level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k - self.first:
            below, width = self.levels[-1], 1 << (self.first + len(self.levels) - 1)
            some = max(0, len(below) - width)
            self.levels.append(_join(below[:some], below[width : width + some], self.salt + len(self.levels)))
        return self.levels[k - self.first]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        level = np.frexp(np.maximum(sizes, 1).astype(np.float64))[1] - 1
        out = np.zeros(len(sizes), dtype=np.uint64)
        for k in np.unique(level[sizes > 0]).tolist():
            own = np.flatnonzero((level == k) & (sizes > 0))
            table = self._level(k)
            out[own] = _join(table[starts[own]], table[ends[own] - (1 << k)], self.salt + 70)
        return mix(out + sizes.astype(np.uint64), 7)

    def windows(self, size: int) -> np.ndarray:
        """The hash of every window of ``size`` codes, by its start; as ``of`` gives it."""
        n = max(0, self.count - size + 1)
        k = size.bit_length() - 1
        table = self._level(k)
        late = size - (1 << k)
        return mix(_join(table[:n], table[late : late + n], self.salt + 70) + np.uint64(size), 7)


@dataclass
class Chunk:
    """Whole documents: their ids, and their bytes one after the other, cut at ``bounds``."""

    ids: np.ndarray
    data: np.ndarray
    bounds: np.ndarray


def chunks(batch: pa.RecordBatch, key: str, text: str, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """A batch's documents, null texts as empty ones, in chunks of about ``size`` bytes."""
    ids = batch.column(key).to_numpy(zero_copy_only=False)
    column = batch.column(text)
    kind = pa.large_binary()
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) else column.type).cast(kind)
    column = column.fill_null(b"") if column.null_count else column
    if not len(column):
        return
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(ids):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1)
        own = bounds[first : last + 1]
        yield Chunk(ids[first:last], data[own[0] : own[-1]], own - own[0])
        first = last


def is_separator(data: np.ndarray) -> np.ndarray:
    return _SEPARATOR[data]


@dataclass
class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a chunk; ``bounds`` cuts them by document."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray


def words(chunk: Chunk, lower: bool = False, family: int = 0) -> Words:
    data = _LOWER[chunk.data] if lower else chunk.data
    inside = ~_SEPARATOR[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = chunk.bounds[:-1][chunk.bounds[:-1] < chunk.bounds[1:]]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = chunk.bounds[1:][chunk.bounds[:-1] < chunk.bounds[1:]] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(starts, ends, np.searchsorted(starts, chunk.bounds), byte_ranges(data, starts, ends, family))


def starts_within(bounds: np.ndarray, size: int) -> np.ndarray:
    """Which positions begin a window of ``size`` that ends in the same document."""
    n = int(bounds[-1])
    steps = np.zeros(n + 1, dtype=np.int32)
    lasts = bounds[1:] - size + 1
    long = lasts > bounds[:-1]
    np.add.at(steps, bounds[:-1][long], 1)
    np.add.at(steps, lasts[long], -1)
    return np.cumsum(steps[:n]) > 0


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every ``size`` neighbours, by doubling."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Anchors:
    """Sampled positions: each owns the windows that begin at ``lows`` to ``highs``."""

    at: np.ndarray
    lows: np.ndarray
    highs: np.ndarray
    names: np.ndarray


def anchors(codes: RangeHashes, bounds: np.ndarray, window: int, gram: int) -> Anchors:
    """For each window, its first n-gram of least hash; windows that follow each other share it.

    The choice depends on a window's content alone, so equal windows own anchors at equal places.
    """
    begins = np.flatnonzero(starts_within(bounds, window))
    if not len(begins):
        none = np.zeros(0, dtype=np.int64)
        return Anchors(none, none, none, none.astype(np.uint64))
    names = codes.windows(gram)
    if len(names) >> _POSITION_BITS:
        raise ValueError(f"a text of more than {1 << _POSITION_BITS} units")
    low = np.uint64((1 << _POSITION_BITS) - 1)
    packed = (mix(names, 5) & ~low) | np.arange(len(names), dtype=np.uint64)
    least = (sliding_minimum(packed, window - gram + 1)[begins] & low).astype(np.int64)
    fresh = np.ones(len(begins), dtype=bool)
    fresh[1:] = (least[1:] != least[:-1]) | (begins[1:] != begins[:-1] + 1)
    heads = np.flatnonzero(fresh)
    tails = np.append(heads[1:], len(begins)) - 1
    at = least[heads]
    return Anchors(at, begins[heads], begins[tails], names[at])


def covered(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``length`` positions lie in any of the ranges."""
    steps = np.bincount(starts, minlength=length + 1) - np.bincount(ends, minlength=length + 1)
    return np.cumsum(steps[:length]) > 0


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch cut into parts of about ``size`` bytes of text, at least one row each."""
    lengths = batch.column(text).cast(pa.large_binary() if pa.types.is_large_string(batch.column(text).type) else pa.binary())
    ends = np.cumsum(pa.compute.binary_length(lengths).fill_null(0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(first, last - first)
        first = last
