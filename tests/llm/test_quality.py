import math
import random
import re
from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, words

from splitmetrics.llm import linear, ngrams, quality


def brute(text):
    text = text or ""
    parts = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(parts[k : k + 3]) for k in range(len(parts) - 2)]
    marked = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip("\x20\x09\x0a\x0b\x0c\x0d"):
            dup += line in seen
            seen.add(line)
    failed = len(parts) < 50 or 100 * len(marked) > 50 * len(parts)
    return (len(parts), sum(map(len, parts)), sum(c in "#*$%&|<>" for c in text), dup, len(marked), failed)


@settings(deadline=None)
@given(st.text(alphabet="ab# \n\t\x0b\x1cé|") | st.lists(st.sampled_from("abc"), max_size=90).map(" ".join))
def test_counts(text):
    c = quality.counts(text, quality.WORD.findall(text))
    assert (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words, c.failed) == brute(text)


def noisy(seed, count):
    return [w + random.Random(seed).choice(["###", "$$$", "%%%"]) for w in words(seed, count)]


def corpus(spark):
    rows = [(k, " ".join(noisy(k, 80) if k % 4 == 0 else words(k, 80))) for k in range(240)]
    labels = spark.createDataFrame([(k, int(k % 4 != 0), 0) for k in range(120)] + [(3, None, 1), (None, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    return rows, labels


def test_noisy_text_goes_and_clean_text_stays(spark):
    rows, labels = corpus(spark)
    rows += [(900, None), (901, ""), (902, "too short"), (903, "same words here " * 60), (7, rows[7][1]), (None, rows[9][1])]
    docs = documents(spark, rows, clashing=True)
    model = quality.fit(docs, labels)
    found = quality.judge(docs, model).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == brute(texts[r["doc_id"]])
        if r["doc_id"] is not None and r["doc_id"] < 900 and r["doc_id"] >= 120:
            assert r["kept"] == (r["doc_id"] % 4 != 0), r
        assert not (r["kept"] and r["base_failed"]) and (r["probability"] is None) == r["base_failed"]


def test_without_labels_the_rules_decide(spark):
    rows, labels = corpus(spark)
    docs = documents(spark, rows[:8])
    assert quality.fit(docs, labels.limit(0)) is None
    assert quality.fit(docs, labels.where("quality = 1")) is None
    assert all(r["kept"] for r in quality.judge(docs, None).collect())


def test_empty_table(spark):
    docs = documents(spark, []).limit(0)
    assert quality.judge(docs, None).count() == 0


def test_the_fit_is_the_best_and_probabilities_are_those_of_its_weights(spark):
    """A second computation: the gradient of the penalised loss is nearly zero, and scores are sums over features."""
    draw = np.random.default_rng(4)
    x = np.hstack([draw.standard_normal((200, 6)), np.ones((200, 1))])
    good = x[:, 0] + 0.5 * draw.standard_normal(200) > 0
    shares = (np.arange(200) % 4 > 0).astype(int)
    w = linear.binary_logistic(x, shares, good, 1e-2, 3000)
    used = shares.astype(bool)
    loss = 1 / (1 + np.exp(-x[used] @ w)) - good[used]
    assert np.abs(x[used].T @ loss / used.sum() + 1e-2 * w).max() < 1e-6

    rows, labels = corpus(spark)
    docs = documents(spark, rows)
    model = quality.fit(docs, labels)
    chances = {r["doc_id"]: r["probability"] for r in quality.judge(docs, model).collect()}
    for doc_id, text in rows:
        parts = text.split()
        hashed = [xxhash.xxh32_intdigest(w) >> 20 for w in parts]
        terms = Counter(hashed) + Counter(
            ((a * 2654435761 + b + 1) * 2654435761 % 2**32) >> 20 for a, b in zip(hashed, hashed[1:])
        )
        grams = Counter()
        for n in (2, 3, 4):
            for at in range(len(text) - n + 1):
                value = n
                for c in text[at : at + n]:
                    value = (value + ord(c) + 1) * 2654435761 % 2**32
                grams[((value ^ value >> 15) * 2654435761 % 2**32) >> 20] += 1
        score = float(model.weights[-1])
        for offset, found in ((0, terms), (4096, grams)):
            total = sum(found.values())
            score += sum(math.sqrt(n / total) * float(model.weights[offset + k]) for k, n in found.items())
        expected = 1 / (1 + math.exp(-(model.slope * score + model.constant)))
        if chances[doc_id] is not None:
            assert abs(chances[doc_id] - expected) < 1e-4


def test_characters_are_code_points():
    a, b = (ngrams.character_ngrams(t, (2,), 12) for t in ("é漢🙂", "漢🙂é"))
    assert a.sum() == b.sum() == 2 and (a != b).any()
    assert ngrams.character_ngrams("ab", (2,), 12).tolist() == ngrams.byte_ngrams(b"ab", (2,), 12).tolist()


def test_very_long_text(spark):
    rows, labels = corpus(spark)
    long = " ".join(words(5, 300_000))
    docs = documents(spark, [*rows, (999, long)])
    found = [r for r in quality.judge(docs, quality.fit(docs, labels)).collect() if r["doc_id"] == 999]
    assert found[0]["n_words"] == 300_000 and found[0]["probability"] is not None


def test_an_even_vote_counts_as_good(spark):
    rows, _ = corpus(spark)
    labels = [(k, int(k % 4 != 0)) for k in range(120)]
    votes = [(k, 1 - q) for k, q in labels if q]
    frames = [spark.createDataFrame(x, "doc_id long, quality int") for x in (labels, labels + votes)]
    models = [quality.fit(documents(spark, rows), f) for f in frames]
    assert np.allclose(models[0].weights, models[1].weights)
