import random
import re

import pytest
import xxhash
from tables import documents, words

from splitmetrics.llm import suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_spans(texts, length):
    """The words that a passage covers whose words stood before, by document in order."""
    seen, out = set(), {}
    for key, text in texts:
        parts = WORD.findall(text or "")
        covered = set()
        for k in range(len(parts) - length + 1):
            passage = tuple(parts[k : k + length])
            if passage in seen:
                covered.update(range(k, k + length))
            seen.add(passage)
        spans = []
        for k in sorted(covered):
            if spans and spans[-1][1] == k:
                spans[-1][1] = k + 1
            else:
                spans.append([k, k + 1])
        out[key] = [tuple(s) for s in spans]
    return out


def corpus():
    draw = random.Random(5)
    shared = [words(1000 + k, draw.randint(8, 40)) for k in range(8)]
    texts = []
    for k in range(60):
        body = words(k % 50, draw.randint(0, 120))
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(body))
            passage = list(draw.choice(shared))
            if draw.random() < 0.4:
                passage[draw.randrange(len(passage))] = "edited"
            low = draw.randint(0, 5)
            body[at:at] = passage[low:]
        texts.append(" ".join(body))
    texts += [None, "", "few words only", "same " * 40, texts[3], texts[3] + "\n\tend", "a b " * 30]
    return texts


@pytest.mark.parametrize(("length", "gram"), [(12, 6), (12, 1), (12, 12), (20, 9)])
def test_spans_are_the_repeated_passages(spark, length, gram):
    texts = corpus()
    found = suffix_dedup.repeated_passages(documents(spark, texts), length, gram).collect()
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in found}
    expected = {k: v for k, v in brute_spans(list(enumerate(texts)), length).items() if v}
    assert got == expected
    assert len(expected) > 10


def test_neighbours_bound_every_match():
    draw = random.Random(8)
    texts = ["".join(f"{draw.choice('abc')} " for _ in range(draw.randint(1, 12))) for _ in range(300)]
    texts += ["ab c ", "a bc ", "a\x01 c ", "a c ", "a "]
    rows = sorted(((k, 0, 0, text) for k, text in enumerate(texts)), key=lambda row: row[3].encode())
    found = list(suffix_dedup.neighbours(iter(rows), 10))
    assert [row for row, _ in found] == rows
    for k, (row, reach) in enumerate(found):
        most = max(suffix_dedup.shared_words(row[3], other[3]) for other in rows if other is not row)
        assert reach == (10 if k in (0, len(rows) - 1) else min(10, most))


def test_a_suffix_that_is_listed_twice_is_no_neighbour():
    rows = [(1, 0, 0, "a b "), (1, 0, 0, "a b "), (1, 0, 4, "a c "), (None, 0, 0, "d "), (2, 0, 0, "e ")]
    assert [reach for _, reach in suffix_dedup.neighbours(iter(rows), 5)] == [5, 1, 0, 5]
    assert list(suffix_dedup.neighbours(iter([]), 5)) == []


def test_passages_extend_left_and_as_far_right_as_the_neighbours():
    parts = [f"w{k}" for k in range(20)]
    before, suffix = ("".join(f"{w} " for w in parts[a:b]) for a, b in [(4, 7), (7, 18)])
    row = (7, 4, 10, before, suffix)  # passages of 8 words that start at 4 to 10, gram at 7
    for reach, starts in [(8, [4, 5, 6, 7]), (11, [4, 5, 6, 7, 8, 9, 10]), (6, [4, 5]), (4, [])]:
        found = dict(suffix_dedup.passages(row, reach, 8))
        assert list(found) == starts
        assert all(found[s] == xxhash.xxh3_128_digest("".join(f"{w} " for w in parts[s : s + 8]).encode()) for s in starts)


def test_hot_gram_with_other_surroundings(spark):
    """A gram that all documents have, in ranges that cut it, with passages that only two have."""
    gram = words(77, 6)
    texts = [" ".join([*words(k, 9), *gram, *words(k + 500, 9)]) for k in range(400)]
    texts += [" ".join([*words(k, 9)[5:], *gram, *words(k + 500, 9)[:3]]) for k in range(0, 400, 40)]
    found = suffix_dedup.repeated_passages(documents(spark, texts), 12, 6).collect()
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in found}
    expected = {k: v for k, v in brute_spans(list(enumerate(texts)), 12).items() if v}
    assert got == expected
    assert set(got) == set(range(400, 410))


def test_text_without_the_spans(spark):
    passage = " ".join(words(1, 60))
    texts = ["first " + passage + " end", "lead  in\n" + passage + "\n\nrest of it", passage, None, "", passage]
    rows = [*enumerate(texts[:5]), (5, passage), (5, passage), (None, passage), (7, "plain")]
    docs = documents(spark, rows, clashing=True)
    found = suffix_dedup.drop_repeated_passages(docs).select("row.doc_id", "row.tag", "cleaned").collect()
    assert sorted(((str(r["doc_id"]), r["cleaned"]) for r in found), key=str) == sorted(
        [("0", texts[0]), ("1", "lead  in\nrest of it"), ("2", ""), ("3", None), ("4", ""), ("5", ""), ("5", ""), ("7", "plain"), ("None", "")],
        key=str,
    )
    assert {r["tag"] for r in found} == {"a"}


def test_long_text_of_one_word(spark):
    found = suffix_dedup.repeated_passages(documents(spark, ["w " * 30_000])).collect()
    assert [(s["start"], s["end"]) for s in found[0]["spans"]] == [(1, 30_000)]


def test_empty_table(spark):
    assert suffix_dedup.drop_repeated_passages(documents(spark, []).limit(0)).count() == 0
