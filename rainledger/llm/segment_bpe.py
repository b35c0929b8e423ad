"""Byte-level BPE by a segment tree over byte positions.

A piece is held as its bytes; every live position starts a part, and the leaf of a position holds the rank of that part's
pair with the next one, followed by the position itself. An inner node holds the lesser of its two children, so the root is
the leftmost pair of least rank. A merge kills one position and refreshes three leaves: the merged part's, the killed one's and
the one before; each refresh walks from the leaf to the root. Short new pieces take these steps together, a row of a matrix of
trees each; a long one has a tree of its own (some 100 bytes of memory for each of its bytes). Recent pieces, and recent parts
of texts between single spaces, are remembered per worker process.

Pieces are the matches of the vocabulary's pattern. Which characters beyond the Latin blocks are letters or digits is asked of
the tiktoken library's own engine: engines know different versions of Unicode.

Null texts are empty: no tokens. Rows that repeat an id, or have none, are encoded each by itself. Other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import grams
from .byte_tokens import Memory

MEMORY = 200_000
#: Longer pieces have a tree of their own; longer parts of a text are not remembered.
ROW_BYTES, PART_CHARS = 64, 128
_NONE = 1 << 62
#: A space between characters that are no white space begins a new piece, whatever surrounds it.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: The first character that is not in the Latin blocks.
_BEYOND = "ɐ"


class Letters:
    """Makes a character that the two engines class differently one that both class as tiktoken's does."""

    def __init__(self):
        import tiktoken

        single = {bytes([b]): b for b in range(256)}
        engine = lambda name, pattern: tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=single, special_tokens={})
        self.kinds = [(kind, engine(stand_in, kind), regex.compile(kind), stand_in) for kind, stand_in in ((r"\p{L}", "a"), (r"\p{N}", "1"))]
        self.asked: set[str] = set()
        self.instead: dict[int, str] = {}

    def settled(self, text: str) -> str:
        """A text of the same length whose pieces are those of tiktoken's engine."""
        new = {c for c in text if c >= _BEYOND} - self.asked
        if new:
            self.asked |= new
            joined, own, theirs = "".join(sorted(new)), {}, {}
            for _, engine, mine, stand_in in self.kinds:
                theirs |= dict.fromkeys(bytes(engine.encode_ordinary(joined)).decode(), stand_in)
                own |= dict.fromkeys("".join(mine.findall(joined)), stand_in)
            self.instead |= {ord(c): theirs.get(c, "!") for c in new if theirs.get(c) != own.get(c)}
        return text.translate(self.instead) if self.instead else text


class SegmentBpe:
    """The ranks of a byte-level vocabulary, and both directions."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        count = max(self.ranks.values()) + 1
        self.sizes = np.zeros(count, dtype=np.int64)
        for token, rank in self.ranks.items():
            self.sizes[rank] = len(token)
        self.tokens = np.frombuffer(b"".join(sorted(self.ranks, key=self.ranks.__getitem__)), dtype=np.uint8)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        get = self.ranks.get
        self.pairs = {
            (left << 32) | right: rank
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := get(token[:cut])) is not None and (right := get(token[cut:])) is not None
        }
        keys = np.array(list(self.pairs), dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.pairs.values()), dtype=np.int64)[order]
        self.pattern, self.letters = regex.compile(pattern), Letters()
        self.pieces, self.parts = Memory(MEMORY), Memory(MEMORY)

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        """The leaf of each pair of parts that starts at ``at``; a part of -1 is none."""
        keys = (left << 32) | right
        found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        merges = (self.pair_keys[found] == keys) & (right >= 0)
        return np.where(merges, (self.pair_ranks[found] << bits) | at, _NONE)

    def _merge_rows(self, pieces: list[bytes], bits: int) -> list[bytes]:
        """The ids of pieces of at most ``2 ** bits`` bytes, one tree a row, all rows a merge at a time."""
        n, width = len(pieces), 1 << bits
        sizes = np.array(list(map(len, pieces)))
        places = np.arange(width + 1)
        inside = places < sizes[:, None]
        parts = np.full((n, width + 1), -1, dtype=np.int64)
        parts[inside] = self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        after, before = np.tile(places + 1, (n, 1)), np.tile(places - 1, (n, 1))
        alive = inside.copy()
        tree = np.full((n, 2 * width), _NONE, dtype=np.int64)
        tree[:, width:] = self._leaves(parts[:, :-1], parts[:, 1:], places[:-1], bits)
        for level in reversed(range(bits)):
            low = 2 << level
            np.minimum(tree[:, low : 2 * low : 2], tree[:, low + 1 : 2 * low : 2], out=tree[:, low // 2 : low])
        rows = np.arange(n)
        while True:
            best = tree[rows, 1]
            rows, best = rows[best < _NONE], best[best < _NONE]
            if not len(rows):
                break
            at = best & (width - 1)
            killed = after[rows, at]
            right, left = after[rows, killed], before[rows, at]
            parts[rows, at], after[rows, at], before[rows, right] = best >> bits, right, at
            alive[rows, killed] = False
            tree[rows, width + killed] = _NONE
            tree[rows, width + at] = self._leaves(parts[rows, at], parts[rows, right], at, bits)
            some = left >= 0
            own, places_left = rows[some], left[some]
            tree[own, width + places_left] = self._leaves(parts[own, places_left], parts[own, at[some]], places_left, bits)
            owners = np.concatenate([rows, rows, own])
            nodes = width + np.concatenate([killed, at, places_left])
            for _ in range(bits):
                tree[owners, nodes >> 1] = np.minimum(tree[owners, nodes], tree[owners, nodes ^ 1])
                nodes = nodes >> 1
        ids, ends = parts[alive].astype("<u4").tobytes(), 4 * np.cumsum(alive.sum(axis=1))
        return [ids[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def _merge_long(self, piece: bytes) -> bytes:
        """The ids of one piece by a tree of its own."""
        n, bits = len(piece), (len(piece) - 1).bit_length()
        width, pairs = 1 << bits, self.pairs
        parts = np.append(self.bytes[np.frombuffer(piece, dtype=np.uint8)], -1)
        whole = np.full(2 * width, _NONE, dtype=np.int64)
        whole[width : width + n] = self._leaves(parts[:-1], parts[1:], np.arange(n), bits)
        for level in reversed(range(bits)):
            low = 2 << level
            np.minimum(whole[low : 2 * low : 2], whole[low + 1 : 2 * low : 2], out=whole[low // 2 : low])
        numbers = lambda values: array("q", values.astype(np.int64).tobytes())
        tree, parts = numbers(whole), numbers(parts)
        after, before = numbers(np.arange(1, n + 2)), numbers(np.arange(-1, n))

        def leaf(at: int, value: int) -> None:
            node = width + at
            tree[node] = value
            while node > 1:
                other, node = tree[node ^ 1], node >> 1
                least = value if value < other else other
                if tree[node] == least:
                    return
                tree[node] = value = least

        def pair(at: int, next_part: int) -> int:
            rank = pairs.get((parts[at] << 32) | parts[next_part]) if next_part < n else None
            return _NONE if rank is None else (rank << bits) | at

        while (best := tree[1]) < _NONE:
            at = best & (width - 1)
            killed = after[at]
            right, left = after[killed], before[at]
            parts[at], parts[killed], after[at] = best >> bits, -1, right
            before[right] = at
            leaf(killed, _NONE)
            leaf(at, pair(at, right))
            if left >= 0:
                leaf(left, pair(left, at))
        kept = np.frombuffer(parts, dtype=np.int64)
        return kept[kept >= 0].astype("<u4").tobytes()

    def _learn(self, pieces: set[str], known: dict[str, bytes]) -> None:
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            data = piece.encode()
            rank = self.ranks.get(data)
            if rank is not None:
                known[piece] = rank.to_bytes(4, "little")
            elif len(data) > ROW_BYTES:
                known[piece] = self._merge_long(data)
            else:
                groups.setdefault((len(data) - 1).bit_length(), []).append((piece, data))
        for bits, group in groups.items():
            known.update(zip([piece for piece, _ in group], self._merge_rows([data for _, data in group], bits)))

    def split(self, text: str) -> list[str]:
        """The pieces of a text, each encoded by itself."""
        if text.isascii() or max(text) < _BEYOND:
            return self.pattern.findall(text)
        settled = self.letters.settled(text)
        return [text[slice(*m.span())] for m in self.pattern.finditer(settled)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        parts = []
        for text in texts:
            words = text.split(" ")
            if "" in words or len(text.split()) != len(words):
                words = _CUT.split(text)
            parts.append([words[0], *[" " + word for word in words[1:]]])
        new = self.parts.missing(set().union(*parts))
        split = {part: self.split(part) for part in new}
        fresh = self.pieces.missing(set().union(*split.values()))
        self._learn(fresh, self.pieces.young)
        ids = self.pieces.young.__getitem__
        known = self.parts.young
        known.update((part, b"".join(map(ids, pieces))) for part, pieces in split.items())
        found = [b"".join(map(known.__getitem__, own)) for own in parts]
        for memory, seen in ((self.parts, new), (self.pieces, fresh)):
            for long in [text for text in seen if len(text) > PART_CHARS]:
                del memory.young[long]
        return found

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids' tokens, one after the other."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shifts = np.repeat(self.begins[ids] - (ends - sizes), sizes)
        return self.tokens[shifts + np.arange(len(shifts))]


@cache
def segment_bpe(ranks: str, pattern: str) -> SegmentBpe:
    """One per worker process, with what it remembers."""
    return SegmentBpe(ranks, pattern)


def encode_and_decode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ``ids`` and ``decoded`` (the bytes that the ids stand for) of every whole text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = segment_bpe(ranks, pattern)
        for batch in batches:
            for part in grams.slices(batch, "text"):
                found = bpe.encode([text or "" for text in part.column("text").to_pylist()])
                counts = np.array([len(data) // 4 for data in found], dtype=np.int64)
                ends = np.append(0, np.cumsum(counts))
                ids = np.frombuffer(b"".join(found), dtype="<u4").astype(np.int32)
                data = bpe.decode(ids)
                cuts = np.append(0, np.cumsum(bpe.sizes[ids]))[ends]
                blobs = [data[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts), lists, pa.array(blobs, pa.binary())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    narrow = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return narrow.mapInArrow(read, "doc_id long, n_tokens long, ids array<int>, decoded binary")
