"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

Each prefix of a word has one encoding, so it has one last token. An automaton over the vocabulary
lists, while it reads the word byte by byte, every token that ends there (the matches that are suffixes of the prefix). Of these,
the last token of the prefix is the one that goes together with the last token of what stands before
it: two tokens go together if encoding their joined bytes gives these two again, which can be told
from the merges that made them. The last tokens are stored for every prefix, and following them
back from the end gives the ids. The time is linear in the length of a word, whatever it is.

Two neighbours go together unless some pair across their border would have been merged. What borders on
the border from the left are the right-hand parts of the left token, each from the merge that made it
until the one that used it up; likewise on the right. A pair of parts that were there at the same time,
and whose own merge comes before either is used up, would have been merged across the border.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from splitmetrics.llm.rows import map_rows
from splitmetrics.llm.tokens import VOCABULARY

# Fixed value: the pattern that cuts a text into words for byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

_NEVER = 1 << 62
#: Words that a task remembers, up to this many characters each; longer ones are encoded each time.
_REMEMBERED = 1 << 20
_LONGEST_REMEMBERED = 64


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary file.

    Bytes with a visible Latin-1 character stand for themselves; the others, in
    order, are the characters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Words(dict):
    """Encoded words as little-endian 32-bit ids; computed when first asked for."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.encode(word.encode("utf-8", "replace")), "<u4").tobytes()
        if len(word) <= _LONGEST_REMEMBERED:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """A byte-level vocabulary with its merges, from a file of the tokenizers library."""

    def __init__(self, vocabulary: dict):
        model, of_character = vocabulary["model"], byte_characters()

        def raw(token: str) -> bytes:
            return bytes(of_character[c] for c in token)

        ids = model["vocab"]
        size = max([*ids.values(), *(t["id"] for t in vocabulary["added_tokens"])]) + 1
        self.special = {t["content"]: t["id"] for t in vocabulary["added_tokens"]}
        self.bytes_of = [b""] * size
        self.made = [-1] * size  # the merge that makes a token; single bytes are there from the start
        self.left, self.right = [0] * size, [0] * size
        self.merges: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            first, second, merged = ids[a], ids[b], ids[a + b]
            self.merges[first, second] = rank
            if self.made[merged] < 0:
                self.made[merged], self.left[merged], self.right[merged] = rank, first, second
        self.ending = ahocorasick.Automaton()
        for token, k in ids.items():
            if token in self.special:
                continue
            self.bytes_of[k] = raw(token)
            if len(token) == 1 or self.made[k] >= 0:
                self.ending.add_word(self.bytes_of[k].decode("latin-1"), (len(token), k))
        self.ending.make_automaton()
        for token, k in self.special.items():
            self.bytes_of[k] = token.encode()
        self.together: dict[int, bool] = {}
        self.size = size
        self.words = _Words(self.encode_word)
        self.pattern = regex.compile(PATTERN)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None

    def _together(self, left: int, right: int) -> bool:
        merges, made = self.merges, self.made
        left_until = right_until = _NEVER
        while True:
            rank = merges.get((left, right))
            # Of equal pairs the one further left is merged first.
            if rank is not None and rank < left_until and rank <= right_until:
                return False
            if made[left] > made[right]:
                left_until, left = made[left], self.right[left]
            elif made[right] >= 0:
                right_until, right = made[right], self.left[right]
            else:
                return True

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of the bytes of one word."""
        last = [-1] * (len(word) + 1)
        together, size = self.together, self.size
        for at, (length, token) in self.ending.iter(word.decode("latin-1")):
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                key = last[start] * size + token
                fits = together.get(key)
                if fits is None:
                    if len(together) >= 2 * _REMEMBERED:
                        together.clear()
                    fits = together[key] = self._together(last[start], token)
                if not fits:
                    continue
            last[end] = token
        ids, end = [], len(word)
        while end:
            ids.append(last[end])
            end -= len(self.bytes_of[last[end]])
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        find, words = self.pattern.findall, self.words.__getitem__
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(map(words, find(text)))
        parts = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                parts.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                parts.extend(map(words, find(part)))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        tokens = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, tokens)).decode("utf-8", "replace")


@cache
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    import public_tokenizers

    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
        return Encoder(json.load(file))


def encode_documents(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and ``ids`` (binary, little-endian unsigned 32-bit) of every document.

    A null text is encoded like an empty one: to no ids.
    """

    def encode(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = encoder(vocabulary)
        for doc_id, text in rows:
            yield doc_id, own.encode(text or "")

    return map_rows(documents.select("doc_id", "text"), encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and text of encoded documents; bytes that are no UTF-8 become U+FFFD."""

    def decode(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = encoder(vocabulary)
        for doc_id, ids in rows:
            yield doc_id, own.decode(ids or b"")

    return map_rows(encoded.select("doc_id", "ids"), decode, "doc_id long, text string")


def round_trip_digests(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 digests of the ids and of the text that they decode to.

    Encodes and decodes in one pass, so that ids of whole documents need not leave their task.
    """

    def compute(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = encoder(vocabulary)
        for doc_id, text in rows:
            ids = own.encode(text or "")
            decoded = own.decode(ids).encode("utf-8", "replace")
            yield doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(documents.select("doc_id", "text"), compute, schema)
