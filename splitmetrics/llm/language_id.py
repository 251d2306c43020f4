"""Language identification in two steps: the family, then machines for pairs within it.

A logistic regression over hashed byte n-grams predicts the language family. Within that family a
linear support vector machine for every pair of languages votes; ties go to the larger sum of margins.

The models are fitted on a bounded sample: up to ``rows_per_language`` labelled rows of each language
(those with the smallest hashes), of the ``max_languages`` most frequent languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitmetrics.llm.linear import logistic, sigmoid, softmax, support_vectors
from splitmetrics.llm.ngrams import byte_ngrams, unit
from splitmetrics.llm.rows import importable, map_rows

UNDETERMINED = "und"

# Families of languages by their ISO 639-1 codes.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "ug", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "austronesian": ("id", "jv", "mg", "ms", "su", "tl"),
}

_SIZES = (1, 2, 3)
_BITS = 12
_LETTER = regex.compile(r"\p{L}")


def family(language: str) -> str:
    """A language that the table does not have is a family of its own."""
    return next((name for name, codes in FAMILIES.items() if language in codes), f"only {language}")


def features(text: str) -> np.ndarray:
    return unit(byte_ngrams(text.lower().encode("utf-8", "surrogatepass"), _SIZES, _BITS))


#: Rows of a language, however many languages there are.
_LEAST_ROWS = 20


@dataclass
class LanguageModel:
    families: list[str]
    family_weights: np.ndarray
    languages: dict[str, list[str]]
    pair_weights: dict[tuple[str, str], np.ndarray]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and a score from 0 to 1; ``und`` and 0 without a letter."""
        if not text or not self.families or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        vector = np.append(features(text), np.float32(1))
        shares = softmax(self.family_weights @ vector)
        best = int(shares.argmax())
        votes = {language: [0, 0.0] for language in self.languages[self.families[best]]}
        trust = dict.fromkeys(votes, 1.0)
        for first, second in combinations(votes, 2):
            margin = float(self.pair_weights[first, second] @ vector)
            won = first if margin >= 0 else second
            votes[won][0] += 1
            votes[first][1] += margin
            votes[second][1] -= margin
            for language, sign in ((first, 1), (second, -1)):
                trust[language] = min(trust[language], float(sigmoid(2 * sign * margin)))
        language = max(votes, key=lambda k: votes[k])
        return language, float(shares[best]) * trust[language]


def _counts(labelled: DataFrame) -> dict[str, int]:
    """Rows of every language: one row of the driver for each."""
    rows = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    return {row["lang"]: row["count"] for row in rows.collect()}


def fit(
    documents: DataFrame,
    training: Column,
    rows_per_language: int = 600,
    sample_rows: int = 40_000,
    penalty: float = 1e-5,
) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of the rows that ``training`` selects.

    About ``rows_per_language`` rows of every language are read, or fewer of each where there are so many languages
    that ``sample_rows`` would be exceeded; no language is left out. Rows without a language or without text are
    not used, and repeated rows count once. Without any row the model predicts ``und``.
    """
    labelled = documents.where(training).where("lang is not null and text is not null")
    counts = _counts(labelled)
    each = max(_LEAST_ROWS, min(rows_per_language, sample_rows // max(1, len(counts))))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, each / n))])
    keyed = labelled.select("lang", "text", F.xxhash64("doc_id", "text").alias("key"))
    chance = F.pmod("key", F.lit(1 << 20)) / F.lit(float(1 << 20))
    if counts:
        # Equal rows have equal keys, so they count once, however many there are.
        chosen = keyed.where(chance < share[F.col("lang")]).groupBy("lang", "key")
        chosen = chosen.agg(F.min("text").alias("text")).select("lang", "text")

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for lang, text in rows:
            if _LETTER.search(text):
                yield lang, features(text).tobytes()

    sample = map_rows(chosen, rows_of, "lang string, vector binary").toArrow() if counts else None
    names = sample["lang"].to_pylist() if counts else []
    if not names:
        return LanguageModel([], np.zeros((0, 0)), {}, {})
    matrix = np.stack([np.frombuffer(v, np.float32) for v in sample["vector"].to_pylist()])
    order = np.lexsort((matrix[:, : min(64, matrix.shape[1])].sum(axis=1), np.array(names)))
    matrix, names = matrix[order], [names[k] for k in order]
    return _fitted(matrix, names, penalty)


def _fitted(matrix: np.ndarray, names: list[str], penalty: float) -> LanguageModel:
    present = sorted(set(names))
    families = sorted({family(name) for name in present})
    index = {name: families.index(family(name)) for name in present}
    members = {f: [name for name in present if family(name) == f] for f in families}
    where = {name: np.array([k for k, n in enumerate(names) if n == name]) for name in present}
    pairs = {}
    for group in members.values():
        for first, second in combinations(group, 2):
            rows = np.concatenate([where[first], where[second]])
            positive = np.arange(len(rows)) < len(where[first])
            pairs[first, second] = support_vectors(matrix[rows], positive, penalty)
    classes = np.array([index[name] for name in names])
    return LanguageModel(families, logistic(matrix, classes, len(families), penalty), members, pairs)


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every row; ``text`` is all that a prediction sees.

    Repeated rows have repeated results; an empty table gives none.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield doc_id, *shared.value.predict(text)

    return map_rows(
        documents.select("doc_id", "text"), predict, "doc_id long, lang_pred string, score double"
    )


def held_out(folds: int = 5) -> Column:
    """The rows that are kept from training: those of fold 0 by the checksum of the id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))


def keep_identified(documents: DataFrame, model: LanguageModel, min_score: float = 0.0) -> DataFrame:
    """The rows whose language is determined, with at least ``min_score`` if one is asked, with all columns.

    Null texts and texts without a letter are rejected, and nothing else by default. The rows pass through Python whole, so
    that nothing is joined.
    """
    importable(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(text: pd.Series) -> pd.Series:
        return text.map(lambda t: _accepts(shared.value, t, min_score)).astype(bool)

    return documents.where(accepted("text"))


def _accepts(model: LanguageModel, text: str | None, min_score: float) -> bool:
    language, score = model.predict(text)
    return language != UNDETERMINED and score >= min_score
