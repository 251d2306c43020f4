"""Repeated passages, found with a sparse suffix array.

A passage of ``length`` words is repeated if the same words stand earlier, in a document of a smaller
doc_id or earlier in the same one (null ids come last; of documents with equal ids the smaller checksum is the earlier).
Every position of a text starts a suffix; only those at minimisers are retained: the k-word gram with the
smallest hash among w in a row, where k + w - 1 = ``length``. What is chosen depends on the words
alone, so two copies of a passage retain a suffix at the same place in it, which owns the passage.

1. Sieve: suffixes whose gram stands once can match none and go. Suffixes that agree in the gram and in all w - 1 words on either
   side are kept once, as the first of them; all passages of the others are repeated. So what very many documents copy is reduced
   before anything is sorted.
2. Sort: the rest, cut to the words that their passages need, are sorted by their words, in ranges that may cut anywhere, also within
   the suffixes of one gram. In sorted order the longest match of a suffix to the right is with a
   neighbour, so the words shared with the two neighbours bound it. At the ends of a range one neighbour is not seen, and the bound
   is taken as ``length``.
3. Extend: from the gram, each match is extended to the left word by word, and to the right as far as the neighbours
   allow: for each d, the d words to the left and length - d to the right are a passage, if the neighbours share as many.
   Its words' 128-bit digest tells whether another suffix has the same one.

So a word is in the result if and only if a repeated passage covers it. Words are runs of other characters than
``[\\x20\\x09-\\x0D]``. Neighbours are compared by their words, passages by 128 bits, and the whole
surroundings of the first step by two 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.llm.rows import identified, importable, map_rows, same_document, with_rows
from splitmetrics.sources.workspace import stage

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MOST = np.uint64(2**64 - 1)
#: Words whose hash a task remembers.
_REMEMBERED = 1 << 20


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        self[word] = value
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Grams:
    """Hashes of the runs of words of one text: ``of(n)`` has the one that starts at each word.

    Runs double: those of 2 ** j words are made from two of half the length. A run of another
    length overlaps two of these.
    """

    def __init__(self, words: np.ndarray):
        self.runs = [_mix(words)]

    def of(self, n: int) -> np.ndarray:
        j = n.bit_length() - 1
        while len(self.runs) <= j:
            half = self.runs[-1]
            size = 1 << (len(self.runs) - 1)
            self.runs.append(_mix(half[:-size] * np.uint64(3) + half[size:]))
        run, size = self.runs[j], 1 << j
        if n == size:
            return run
        count = max(0, len(run) - (n - size))
        return _mix(run[:count] * np.uint64(5) + run[n - size : n - size + count] + np.uint64(n))


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the place of the least (the first of equal ones)."""
    places = np.arange(len(values))
    size = 1
    while size < width:
        step = min(size, width - size)
        left, right = places[:-step], places[step:]
        places = np.where(values[right] < values[left], right, left)
        size += step
    return places


def word_hashes(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def suffixes(words: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Grams]:
    """The words at which the retained suffixes start, and where the first and last passage of each do."""
    grams = Grams(words)
    if len(words) < gram + window - 1:
        return (*np.zeros((3, 0), np.int64), grams)
    at, low, count = np.unique(_window_least(grams.of(gram), window), return_index=True, return_counts=True)
    return at, low, low + count - 1, grams


def _context(words: np.ndarray, grams: Grams, at: np.ndarray, gram: int, side: int) -> np.ndarray:
    """A hash of the ``side`` words before and after each gram, and of how many there are of them."""
    total = len(words)
    left = np.minimum(at, side)
    right = np.minimum(total - at - gram, side)
    out = np.zeros(len(at), np.uint64)
    whole = (left == side) & (right == side)
    runs = grams.of(gram + 2 * side) if whole.any() else None
    if runs is not None:
        out[whole] = runs[at[whole] - side]
    for k in np.flatnonzero(~whole).tolist():
        low, high = at[k] - left[k], at[k] + gram + right[k]
        part = words[low:high].tobytes() + bytes([int(left[k]) % 256, int(right[k]) % 256])
        out[k] = xxhash.xxh64_intdigest(part, 7)
    return out


def _signed(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


def retained(documents: DataFrame, gram: int, window: int) -> DataFrame:
    """The retained suffixes: doc_id, tag, at, low, high (words' numbers), gram and context (hashes).

    ``low`` and ``high`` are where the first and the last passage start that the suffix owns.
    """

    def find(rows: Iterator[tuple]) -> Iterator[tuple]:
        known = _Hashes()
        for doc_id, tag, text in rows:
            words = word_hashes(text, known)
            at, low, high, grams = suffixes(words, gram, window)
            if len(at):
                first = _signed(grams.of(gram)[at])
                around = _signed(_context(words, grams, at, gram, window - 1))
                places = zip(at.tolist(), low.tolist(), high.tolist(), strict=True)
                for place, g, c in zip(places, first, around, strict=True):
                    yield doc_id, tag, *place, g, c

    schema = "doc_id long, tag long, at int, low int, high int, gram long, context long"
    return map_rows(identified(documents), find, schema)


_ME = "struct(doc_id is null as no_id, doc_id, tag, at, low, high)"
_PASSAGE = "struct(doc_id is null as no_id, doc_id, tag, start)"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _written(documents: DataFrame, listed: DataFrame, length: int) -> DataFrame:
    """The listed suffixes with their words: doc_id, tag, at, low, high, before and suffix.

    ``suffix`` has the words from ``at`` to the end of the last passage, each followed by a space, and
    ``before`` those from ``low`` to ``at``.
    """

    def write(rows: Iterator[tuple]) -> Iterator[tuple]:
        last = None
        for doc_id, tag, text, places in rows:
            if (doc_id, tag) == last:  # a repeated row
                continue
            last = doc_id, tag
            words = _WORD.findall(text)
            for place in places:
                at, low, high = place["at"], place["low"], place["high"]
                before, suffix = words[low:at], words[at : high + length]
                yield doc_id, tag, at, low, high, _joined(before), _joined(suffix)

    found = identified(documents).alias("l").join(listed.hint("merge").alias("r"), same_document("l", "r"))
    schema = "doc_id long, tag long, at int, low int, high int, before string, suffix string"
    return map_rows(found.select("l.doc_id", "l.tag", "l.text", "r.places"), write, schema)


def _joined(words: list[str]) -> str:
    return "".join([f"{word} " for word in words])


def shared_words(left: str, right: str) -> int:
    """How many words two suffixes have in common at their beginning."""
    count = 0
    for a, b in zip(left.split(" ")[:-1], right.split(" ")[:-1], strict=False):
        if a != b:
            break
        count += 1
    return count


def neighbours(rows: Iterator[tuple], length: int) -> Iterator[tuple[tuple, int]]:
    """Each suffix of a sorted range and the words that it shares with a neighbour, at most ``length``.

    Rows are (doc_id, tag, at, ..., suffix). The first and the last have a neighbour that is not seen,
    and so have ``length``. A suffix that is listed twice counts once.
    """
    held, shared = None, length
    for row in rows:
        if held is not None:
            if held[:3] == row[:3]:
                continue
            now = min(length, shared_words(held[-1], row[-1]))
            yield held, max(shared, now)
            shared = now
        held = row
    if held is not None:
        yield held, length


def passages(row: tuple, reach: int, length: int) -> Iterator[tuple[int, bytes]]:
    """The start and digest of each passage that a suffix owns and whose right part has at most ``reach`` words."""
    at, low, high, before, suffix = row
    text = (before + suffix).encode("utf-8")
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20) + 1
    ends = [0, *ends.tolist()]
    for start in range(low, min(high, at - length + reach) + 1):
        part = text[ends[start - low] : ends[start - low + length]]
        yield start, xxhash.xxh3_128_digest(part)


def _extended(written: DataFrame, length: int) -> DataFrame:
    """doc_id, tag, start and passage (a digest), after sorting the suffixes and comparing neighbours."""
    order = ("suffix", "doc_id", "tag", "at")
    ranged = written.repartitionByRange(*order).sortWithinPartitions(*order)

    def extend(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (doc_id, tag, *row), reach in neighbours(rows, length):
            for start, digest in passages(tuple(row), reach, length):
                yield doc_id, tag, start, digest

    return map_rows(ranged, extend, "doc_id long, tag long, start int, passage binary")


def repeated_passages(documents: DataFrame, length: int = 50, gram: int = 15) -> DataFrame:
    """doc_id, tag and ``spans``: the words [start, end) that repeated passages cover, in order.

    Only documents that have any. Spans do not overlap or touch. Equal rows are one document.
    """
    if not 0 < gram <= length:
        raise ValueError("a gram has at least one word and no more than a passage")
    every = stage(retained(documents, gram, length - gram + 1), "suffixes")
    # Most grams stand once, and nothing but the gram is shuffled to tell. The grams are staged, as Spark
    # splits a gram that very many documents share only in a join of two tables.
    again = every.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    found = stage(every.join(stage(again, "grams"), "gram", "left_semi"), "repeated_suffixes")
    first = F.min(F.expr(_ME)).alias("first")
    classes = stage(found.groupBy("gram", "context").agg(first), "suffix_classes")
    several = classes.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = stage(several.select("gram"), "mixed_grams")
    copies = (
        found.join(classes, ["gram", "context"])
        .where(F.expr(_ME) != F.col("first"))
        .select("doc_id", "tag", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    )
    heads = classes.join(mixed, "gram").select("first.*")
    listed = heads.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("at", "low", "high")).alias("places"))
    written = stage(_written(documents, stage(listed, "listed_suffixes"), length), "written_suffixes")
    every_passage = stage(_extended(written, length), "passages")
    first = every_passage.groupBy("passage").agg(
        F.min(F.expr(_PASSAGE)).alias("first"), F.count("*").alias("n")
    )
    first = stage(first.where("n > 1").select("passage", "first"), "first_passages")
    later = (
        every_passage.join(first, "passage")
        .where(F.expr(_PASSAGE) != F.col("first"))
        .select("doc_id", "tag", "start", (F.col("start") + length).alias("end"))
    )
    spans = later.union(copies)
    grouped = spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def merge(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, tag, parts in rows:
            merged = _merged([(p["start"], p["end"]) for p in parts])
            yield doc_id, tag, [{"start": a, "end": b} for a, b in merged]

    return map_rows(grouped, merge, "doc_id long, tag long, spans array<struct<start:int,end:int>>")


def without_words(text: str, spans: list) -> str:
    """The text without these words and the white space after each run of them."""
    starts = [m.start() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : starts[span["start"]]])
        at = starts[span["end"]] if span["end"] < len(starts) else len(text)
    return "".join([*kept, text[at:]])


def drop_repeated_passages(documents: DataFrame, length: int = 50, gram: int = 15) -> DataFrame:
    """The struct ``row`` of every document, its ``cleaned`` text, and ``spans``, the words that went.

    A null text stays null. A text of fewer than ``length`` words has no passage and stays as it is.
    """
    importable(documents.sparkSession)

    @F.pandas_udf("string")
    def cleaned(text: pd.Series, spans: pd.Series) -> pd.Series:
        pairs = zip(text, spans, strict=True)
        return pd.Series([t if s is None or t is None else without_words(t, s) for t, s in pairs], dtype=object)

    found = with_rows(documents, repeated_passages(documents, length, gram), "left")
    return found.select("row", "spans", cleaned(F.col("row.text"), "spans").alias("cleaned"))
