import random

import pytest
import xxhash
from tables import documents, words

from splitmetrics.llm import simhash


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts, word = [], ""
    for c in lowered + " ":
        if c == " " or "\x09" <= c <= "\x0d":
            if word:
                parts.append(word)
            word = ""
        else:
            word += c
    shingles = [" ".join(parts[k : k + 3]) for k in range(max(1, len(parts) - 2))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    """For each fingerprint all that it reaches."""
    left, found = set(prints), {}
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            x = todo.pop()
            group.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= bits}
            left -= near
            todo += near
        found |= dict.fromkeys(group, frozenset(group))
    return found


TEXTS = ["", None, "One", "two WORDS", " a\tb\x0bc d  e\n", "Été À la MODE " * 3, "x y z " * 500]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_ring_covers_all_bits():
    for bits in (0, 1, 2, 3, 6):
        masks = [m & (2**64 - 1) for m in simhash.ring(bits)]
        assert len(masks) == 2 * bits + 1 and sum(masks) == 2**64 - 1


@pytest.mark.parametrize(("bits", "pair_limit"), [(2, 64), (2, 3), (1, 64), (3, 8)])
def test_components_of_fingerprints(spark, bits, pair_limit):
    draw = random.Random(bits)
    prints = {draw.getrandbits(64) for _ in range(300)}
    for x in list(prints)[:60]:  # chains and clusters
        for _ in range(12):
            for _ in range(draw.randint(1, 3)):
                x ^= 1 << draw.randrange(64)
            prints.add(x)
    rows = [(k, 0, x - (1 << 64) if x >> 63 else x) for k, x in enumerate(prints)]
    frame = spark.createDataFrame(rows, "doc_id long, tag long, fp long")
    found = {r["fp"] & (2**64 - 1): r["component_id"] for r in simhash.components(frame, bits, pair_limit).collect()}
    ids = {x: k for k, x in enumerate(prints)}
    assert found == {x: min(ids[y] for y in group) for x, group in brute_components(prints, bits).items()}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_rings_of_the_bits_that_are_left(spark):
    draw = random.Random(4)
    for bits in (1, 2, 3):
        fixed = [0, 1, 2**63, 2**40 - 1, draw.getrandbits(64), 2**64 - 2 ** (2 * bits + 1)]
        frame = spark.createDataFrame([(signed(x),) for x in fixed], "fixed long")
        for x, row in zip(fixed, frame.select(simhash._ring_of("fixed", bits).alias("r")).collect(), strict=True):
            masks = [m & (2**64 - 1) for m in row["r"]]
            assert len(masks) == 2 * bits + 1 and sum(masks) == x ^ (2**64 - 1)
            sizes = [m.bit_count() for m in masks]
            assert min(sizes) >= 1 and max(sizes) - min(sizes) <= 1
            if x == 0:
                assert row["r"] == simhash.ring(bits)


@pytest.mark.parametrize(("bits", "pair_limit"), [(2, 8), (1, 4)])
def test_every_link_of_a_crowded_bucket_once(spark, bits, pair_limit):
    """Near a centre, and all values of the lowest bits, so that buckets stay full for several levels."""
    draw = random.Random(9)
    centre = draw.getrandbits(64)
    prints = {centre ^ (1 << k) for k in range(64)} | {centre ^ x for x in range(128)}
    prints |= {centre ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(150)}
    frame = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    found = [(r["a"], r["b"]) for r in simhash.links(frame, bits, pair_limit).collect()]
    values = sorted(map(signed, prints))
    apart = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    wanted = {(a, b) for k, a in enumerate(values) for b in values[k + 1 :] if apart(a, b) <= bits}
    assert len(found) == len(set(found)) and set(found) == wanted


def corpus():
    texts = list(TEXTS)
    for seed in range(12):
        base = words(seed, 120)
        texts += [" ".join(base), " ".join(base), " ".join([*base[:-1], "changed"]), " ".join(base).upper()]
    return texts


def test_groups(spark):
    texts = [*corpus(), *corpus()[:3]]
    found = simhash.simhash_groups(documents(spark, texts, clashing=True)).collect()
    prints = [brute_fingerprint(t) for t in texts]
    reach = brute_components(prints, 2)
    assert len(found) == len(texts)
    for row in found:
        k = row["doc_id"]
        assert row["fingerprint"] == f"{prints[k]:016x}"
        assert row["component_id"] == min(j for j, p in enumerate(prints) if p in reach[prints[k]])


def test_one_of_each_group_stays(spark):
    texts = corpus()
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[10]), (None, "of its own here"), (None, "of its own here")]
    docs = documents(spark, rows, clashing=True)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"] is None, r["doc_id"]), r["text"]) for r in kept.collect())
    prints = [brute_fingerprint(t) for t in texts]
    reach = brute_components([*prints, brute_fingerprint("of its own here")], 2)
    first = {min(j for j, p in enumerate(prints) if p in reach[q]) for q in prints}
    assert got == [*(((False, k), texts[k]) for k in sorted(first)), ((True, None), "of its own here")]


def test_empty_table(spark):
    assert simhash.simhash_groups(documents(spark, []).limit(0)).count() == 0
