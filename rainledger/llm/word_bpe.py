"""BPE encoding and decoding by a contiguous rank array.

A word is held as its parts, and the ranks of all adjacent pairs in one contiguous array. The least rank is found by a
scan; its boundary is deleted and the two neighbouring ranks are refreshed. New words of one length take these steps
together, a row of a matrix each. Words are short, so the scan beats any heap; a run of more than ``SCAN_LIMIT`` parts
uses a heap of the same pairs, which gives the same merges. Recent words are remembered per worker process.

Null texts are empty: no tokens. Rows that repeat an id, or have none, are encoded each by itself. Other columns are
ignored.
"""

from __future__ import annotations

import heapq
import json
import os
import unicodedata
from collections.abc import Iterator
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import grams
from .byte_tokens import Memory

MEMORY = 150_000
SCAN_LIMIT = 64
_NONE = (1 << 31) - 1
#: Stands before a special token among words; no word begins with a space.
_SPECIAL = " "
#: The first character that is not in the Latin blocks.
_BEYOND = "ɐ"


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


class WordBpe:
    """The vocabulary of a BPE file with word ends, and its two directions."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        self.tokens = {i: token for token, i in vocab.items()}
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.rank[vocab[left] << 32 | vocab[right]] = rank
            self.merged.append(vocab[left + right])
        letters = _byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + end] for x in letters]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in special.items()}
        self.special = special
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(split["pattern"]["Regex"])
        self.merged_ids = np.array(self.merged, dtype=np.int32)
        keys = np.array(list(self.rank), dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.rank.values()), dtype=np.int32)[order]
        self.inner_ids, self.last_ids = np.array(self.inner, dtype=np.int32), np.array(self.last, dtype=np.int32)
        self.texts = self.tokens.__getitem__
        # Ids and texts fill together, so their generations change together.
        self.words, self.word_texts = Memory(MEMORY), Memory(MEMORY)
        #: The ids and the decoded text of a part.
        self.parts = Memory(MEMORY)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of parts; ``_NONE`` where they never merge or there is no part."""
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)

    def _merge_rows(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every row of a matrix of parts; the rows' new lengths."""
        n, width = parts.shape
        lengths = np.full(n, width)
        ranks = np.full((n, width), _NONE, dtype=np.int32)
        ranks[:, :-1] = self._ranks(parts[:, :-1], parts[:, 1:])
        places = np.arange(width)
        live = np.arange(n)
        done = parts.copy()
        while len(live):
            at = ranks.argmin(axis=1)
            own = np.arange(len(live))
            least = ranks[own, at]
            going = least < _NONE
            if not going.all():
                done[live[~going]] = parts[~going]
                live, parts, ranks, at, least = live[going], parts[going], ranks[going], at[going], least[going]
                own = np.arange(len(live))
            if not len(live):
                break
            # Delete the boundary after ``at``: everything behind it moves one place forward.
            source = np.minimum(places + (places > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, source, axis=1)
            source = np.minimum(places + (places >= at[:, None]), width - 1)
            ranks = np.take_along_axis(ranks, source, axis=1)
            parts[:, -1], ranks[:, -1] = -1, _NONE
            parts[own, at] = self.merged_ids[least]
            lengths[live] -= 1
            ranks[own, at] = self._ranks(parts[own, at], parts[own, np.minimum(at + 1, width - 1)])
            before = at > 0
            ranks[own[before], at[before] - 1] = self._ranks(parts[own[before], at[before] - 1], parts[own[before], at[before]])
        return done, lengths

    def _learn(self, words: list[str]) -> None:
        """Encode new words: those of one length together."""
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            data = word.encode()
            by_length.setdefault(len(data), []).append((word, data))
        for size, group in by_length.items():
            if size > SCAN_LIMIT:
                for word, data in group:
                    ids = self._merge_long([self.inner[b] for b in data[:-1]] + [self.last[data[-1]]])
                    self.words.young[word] = pack(f"<{len(ids)}I", *ids)
                    self.word_texts.young[word] = self.decode(ids)
                continue
            letters = np.frombuffer(b"".join([d for _, d in group]), dtype=np.uint8).reshape(len(group), size)
            parts = np.concatenate([self.inner_ids[letters[:, :-1]], self.last_ids[letters[:, -1:]]], axis=1)
            done, lengths = self._merge_rows(parts)
            whole, texts, ids = done.astype("<u4").tobytes(), self.texts, done.tolist()
            names = [word for word, _ in group]
            steps = range(0, 4 * size * len(group), 4 * size)
            self.words.young.update(zip(names, [whole[a : a + 4 * n] for a, n in zip(steps, lengths.tolist())]))
            decoded = [" ".join(map(texts, row[:n])) for row, n in zip(ids, lengths.tolist())]
            self.word_texts.young.update(zip(names, decoded))

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order: least rank first, leftmost among equals."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.rank.get(parts[i] << 32 | parts[i + 1], _NONE), i, parts[i], parts[i + 1]) for i in range(n - 1)]
        heap = [x for x in heap if x[0] < _NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    found = self.rank.get(parts[a] << 32 | parts[b], _NONE)
                    if found < _NONE:
                        heapq.heappush(heap, (found, a, parts[a], parts[b]))
        return [p for p in parts if p >= 0]

    def _split(self, text: str) -> list[str]:
        """The words of a text; special tokens are matched before anything else, and are words of their own."""
        if text.isascii():
            if text.isalpha():
                return [text.lower()]
            if text[-1:] in (".", ",") and text[:-1].isalpha():
                return [text[:-1].lower(), text[-1]]
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self._plain(text)
        parts = self.special_pattern.split(text)
        return [x for p in parts if p for x in ([_SPECIAL + p] if p in self.special else self._plain(p))]

    def _plain(self, text: str) -> list[str]:
        if not text.isascii() and max(text) >= _BEYOND:
            # Engines know different versions of Unicode: the file's own normaliser and cuts decide.
            text = self.library.normalizer.normalize_str(text)
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        text = unicodedata.normalize("NFC", text)
        # Lower case letter by letter: no final form of sigma.
        text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
        return self.split.findall(text)

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space: the file names no decoder."""
        return " ".join([self.tokens[i] for i in ids])

    def encode_decode(self, texts: list[str]) -> list[tuple[int, bytes, str]]:
        """For each text the number of ids, the ids (little-endian, 32 bits), and the decoded text.

        White space is dropped and no rule reaches across it, so the parts between spaces are looked up alone.
        """
        parts = [text.split(" ") for text in texts]
        wanted = set().union(*parts)
        new = self.parts.missing(wanted)
        # Most parts are one word of ASCII letters.
        single = {part: part.lower() for part in new if part.isalpha() and part.isascii()}
        split = [(part, self._split(part)) for part in new if part not in single]
        words = set(single.values()).union(*[own for _, own in split])
        fresh = self.words.missing(words)
        self.word_texts.missing(words)
        for word in [w for w in fresh if w[0] == _SPECIAL]:
            fresh.discard(word)
            self.words.young[word] = pack("<I", self.special[word[1:]])
            self.word_texts.young[word] = word[1:]
        self._learn(list(fresh))
        word_ids, word_text = self.words.young.__getitem__, self.word_texts.young.__getitem__
        known = self.parts.young
        known.update(zip(single, zip(map(word_ids, single.values()), map(word_text, single.values()))))
        known.update([(part, (b"".join(map(word_ids, own)), " ".join(map(word_text, own)))) for part, own in split])
        out = []
        for own in parts:
            found = [known[part] for part in own]
            data = b"".join([ids for ids, _ in found])
            out.append((len(data) // 4, data, " ".join([decoded for _, decoded in found if decoded])))
        return out


@cache
def word_bpe(path: str) -> WordBpe:
    """One per worker process, with what it remembers."""
    return WordBpe(path)


def encode_and_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` for every whole text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        for batch in batches:
            for part in grams.slices(batch, "text"):
                counts, ids, decoded = zip(*bpe.encode_decode([text or "" for text in part.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    narrow = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return narrow.mapInArrow(read, "doc_id long, n_tokens long, ids binary, decoded string")
