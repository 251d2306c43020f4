"""Quality rules: fixed rules on counts, then a calibrated classifier over hashed n-grams.

A logistic regression over hashed words, pairs of words and n-grams of characters (code points) is fitted on labelled rows. Part
of the sample is kept aside to turn its scores into probabilities (Platt scaling). Rows reach the driver as
their non-zero features only. Documents are scored in Arrow batches;
a document is kept if no rule fails and the probability of good quality reaches a fixed threshold.

The sample is at most about ``sample_rows`` labelled rows, those with the smallest hashes of doc_id. Its bound is also
that of what is broadcast and collected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.llm.linear import binary_logistic, platt, sigmoid
from splitmetrics.llm.ngrams import character_ngrams, unit
from splitmetrics.llm.rows import map_rows

# What counts as a word and as a symbol, and the limits of the rules.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

_SIZES = (2, 3, 4)
_BITS = 12
_REMEMBERED = 1 << 20
_MULTIPLIER = np.uint32(2654435761)


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        bucket = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")) >> (32 - _BITS)
        self[word] = bucket
        return bucket


@dataclass(frozen=True)
class Counts:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED_PERCENT * self.n_words


def counts(text: str, words: list[str]) -> Counts:
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return Counts(
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _in_repeated_windows(words),
    )


def _in_repeated_windows(words: list[str], width: int = 3) -> int:
    """Words in windows of ``width`` words that the text has twice or more."""
    windows = list(zip(*(words[k:] for k in range(width)), strict=False))
    found = Counter(windows)
    if len(found) == len(windows):
        return 0
    covered, upto = 0, 0
    for at, window in enumerate(windows):
        if found[window] > 1:
            covered += at + width - max(at, upto)
            upto = at + width
    return covered


def features(text: str, words: list[str], buckets: dict[str, int]) -> np.ndarray:
    """Two vectors of length one side by side: words with their pairs, and n-grams of characters."""
    hashed = np.fromiter(map(buckets.__getitem__, words), np.uint32, len(words))
    pairs = (hashed[:-1] * _MULTIPLIER + hashed[1:] + np.uint32(1)) * _MULTIPLIER >> np.uint32(32 - _BITS)
    own = np.bincount(hashed, minlength=1 << _BITS) + np.bincount(pairs, minlength=1 << _BITS)
    return np.concatenate([unit(own), unit(character_ngrams(text, _SIZES, _BITS))])


def _packed(vector: np.ndarray) -> tuple[bytes, bytes]:
    places = np.flatnonzero(vector).astype(np.uint16)
    return places.tobytes(), vector[places].tobytes()


def _unpacked(places: list, values: list) -> np.ndarray:
    """The rows as a matrix with a last column of ones, filled in place."""
    matrix = np.zeros((len(places), (2 << _BITS) + 1), np.float32)
    matrix[:, -1] = 1
    for row, (at, value) in enumerate(zip(places, values, strict=True)):
        matrix[row, np.frombuffer(at.as_buffer(), np.uint16)] = np.frombuffer(value.as_buffer(), np.float32)
    return matrix


@dataclass
class QualityModel:
    weights: np.ndarray
    slope: float
    constant: float

    def probability(self, vector: np.ndarray) -> float:
        score = float(self.weights[:-1] @ vector + self.weights[-1])
        return float(sigmoid(self.slope * score + self.constant))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    sample_rows: int = 4000,
    held_out: float = 0.25,
    penalty: float = 3e-5,
) -> QualityModel | None:
    """Learn from ``labels(doc_id, quality)``; None if the sample has only one kind, or nothing.

    Labels without quality or id are left out. A document with several labels takes their majority, good if even.
    """
    usable = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
    total = usable.count()
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = usable.where(chance < min(1.0, sample_rows / max(1, total)))
    chosen = chosen.groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    texts = documents.where("text is not null").select("doc_id", "text")

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        buckets = _Buckets()
        for doc_id, text, good in rows:
            words = WORD.findall(text)
            if words:
                yield doc_id, good, *_packed(features(text, words, buckets))

    # One text for an id, however many rows it has.
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
    sample = sample.agg(F.min("text").alias("text"), F.first("good").alias("good"))
    found = map_rows(sample, rows_of, "doc_id long, good boolean, places binary, features binary").toArrow()
    good = np.array(found["good"].to_pylist(), bool)
    if not good.any() or good.all():
        return None
    found = found.take(np.argsort(found["doc_id"].to_numpy(), kind="stable"))
    good = np.array(found["good"].to_pylist(), bool)
    return _fitted(_unpacked(found["places"], found["features"]), good, held_out, penalty)


def _fitted(matrix: np.ndarray, good: np.ndarray, held_out: float, penalty: float) -> QualityModel:
    """``matrix`` has a last column of ones. Rows that are kept aside have no weight in the fit."""
    aside = np.zeros(len(good), bool)
    for kind in (False, True):  # of either kind the same share, spread over the sample
        rows = np.flatnonzero(good == kind)
        aside[rows[:: max(2, round(1 / held_out))]] = len(rows) > 1
    if aside.all() or not (good[~aside].any() and not good[~aside].all()):
        aside[:] = False
    weights = binary_logistic(matrix, np.where(aside, 0, 1), good, penalty, 400)
    rest = aside if aside.any() else ~aside
    scores = (matrix @ weights).astype(np.float64)[rest]
    return QualityModel(weights, *platt(scores, good[rest]))


def judge(documents: DataFrame, model: QualityModel | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, the counts, base_failed, probability (null if a rule fails or there is no model) and kept.

    A null text has no words, like an empty one, and fails. Without a model the rules alone decide. Every row
    is judged on its own, so equal rows have equal results.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(rows: Iterator[tuple]) -> Iterator[tuple]:
        buckets = _Buckets()
        for doc_id, text in rows:
            text = text or ""
            words = WORD.findall(text)
            found = counts(text, words)
            chance = None
            if shared.value is not None and not found.failed:
                chance = shared.value.probability(features(text, words, buckets))
            yield (
                doc_id,
                found.n_words,
                found.word_chars,
                found.n_symbols,
                found.n_dup_lines,
                found.n_repeat_words,
                found.failed,
                chance,
                not found.failed and (chance is None or chance >= threshold),
            )

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, probability double, kept boolean"
    )
    return map_rows(documents.select("doc_id", "text"), score, schema)
