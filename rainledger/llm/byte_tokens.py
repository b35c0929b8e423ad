"""Byte-level BPE ids of whole texts, equal to the tokenizer file's, with a memory of recent words.

A space between two characters that are not white space always starts a new pre-token, so a text may be cut there and each part
looked up by itself. Texts with other spacing, or with a special token, are encoded whole. Characters
beyond the Latin blocks go to the tokenizer itself: regular-expression engines may not agree on
newer Unicode letters.
"""

from __future__ import annotations

import base64
import os
import re
from functools import cache

import numpy as np

#: Words in each of the two generations of the memory.
MEMORY = 250_000
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _odd(word: str) -> bool:
    """Whether a space before this part does not surely start a new pre-token."""
    return not word or word[0].isspace() or word[-1].isspace()


def _latin(text: str) -> bool:
    return text.isascii() or max(text) < "ɐ"


class Memory:
    """What was seen lately: a full generation becomes the old one, and what is asked for again moves back."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, wanted: set) -> set:
        new = wanted - self.young.keys()
        if len(self.young) + len(new) > self.size:
            self.old, self.young = self.young, {}
            new = wanted
        again = new & self.old.keys()
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        return new - again


class ByteTokens:
    def __init__(self, tokenizer: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer)
        added = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.sizes = np.zeros(max(merges.values()) + 1, dtype=np.int64)
        for word, rank in merges.items():
            self.sizes[rank] = len(word)
        self.fast = tiktoken.Encoding("bytes", pat_str=_PATTERN, mergeable_ranks=merges, special_tokens={})
        self.memory = Memory(MEMORY)

    def _encode(self, text: str) -> bytes:
        if self.special.search(text) or not _latin(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> set[str]:
        """Encode the parts, a space before each, in one call, and cut the ids where the parts end.

        Returns the parts that can't be encoded by themselves.
        """
        joined = " " + " ".join(words)
        letters, odd, known = set(joined), set(), self.memory.young
        if any(x.isspace() for x in letters - {" "}) or "  " in joined or joined == " ":
            odd = {word for word in words if _odd(word)}
        if odd or max(letters) >= "ɐ":
            apart = [word for word in words if word not in odd and not _latin(word)]
            known.update((word, self._encode(" " + word)) for word in apart)
            words = [word for word in words if word not in odd and _latin(word)]
            joined = " " + " ".join(words)
        if words:
            data = np.frombuffer(joined.encode(), dtype=np.uint8)
            ids = np.array(self.fast.encode_ordinary(joined), dtype="<u4")
            cuts = np.append(np.flatnonzero(data == 32)[1:], len(data))
            ends = (4 * np.searchsorted(np.cumsum(self.sizes[ids]), cuts, side="right")).tolist()
            whole = ids.tobytes()
            known.update(zip(words, [whole[a:b] for a, b in zip([0, *ends], ends)]))
        return odd

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        parts = [None if self.special.search(text) else text.split(" ") for text in texts]
        heads = [split.pop(0) if split else "" for split in parts]
        odd = self._learn(list(self.memory.missing(set().union(*filter(None, parts)))))
        get = self.memory.young.__getitem__
        return [
            self._encode(text)
            if split is None or (odd and not odd.isdisjoint(split))
            else self._encode(head) + b"".join(map(get, split))
            for text, head, split in zip(texts, heads, parts)
        ]


@cache
def byte_tokens(tokenizer: str, ranks: str) -> ByteTokens:
    """One per worker process, with what it remembers."""
    return ByteTokens(tokenizer, ranks)
