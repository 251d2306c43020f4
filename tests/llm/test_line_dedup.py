import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, words

from splitmetrics.llm import line_dedup
from splitmetrics.llm.line_dedup import aligned, matches


def common_length(a, b):
    """Length of a longest common subsequence, by the textbook table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(0, 12), max_size=25), st.lists(st.integers(0, 12), max_size=25))
def test_matches_are_an_alignment(later, earlier):
    found = matches(later, earlier)
    assert all(later[i] == earlier[j] for i, j in found)
    assert all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:]))
    assert bool(found) == bool(set(later) & set(earlier))


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_without_unique_lines_it_is_a_longest_common_subsequence(later, earlier):
    found = sorted(line_dedup._common(later, earlier, 0, len(later), 0, len(earlier)))
    assert all(later[i] == earlier[j] for i, j in found)
    assert all(a < c and b < d for (a, b), (c, d) in zip(found, found[1:]))
    assert len(found) == common_length(later, earlier)


@settings(deadline=None, max_examples=200)
@given(st.permutations(range(12)), st.permutations(range(12)))
def test_unique_lines_are_anchored_in_the_longest_order(later, earlier):
    assert len(matches(later, earlier)) == common_length(later, earlier)


@settings(deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=30, unique=True), st.data())
def test_a_common_run_of_unique_lines_is_found(run, data):
    before = data.draw(st.lists(st.integers(20_000, 30_000), max_size=9))
    after = data.draw(st.lists(st.integers(30_001, 40_000), max_size=9))
    assert aligned([*before, *run, *after], [-1, *run, -2]) == list(range(len(before), len(before) + len(run)))


def test_of_swapped_blocks_one_stays():
    assert aligned([3, 4, 9, 1, 2], [1, 2, 8, 3, 4]) in ([0, 1], [3, 4])
    assert aligned([3, 4, 5, 9, 1, 2], [1, 2, 8, 3, 4, 5]) == [0, 1, 2]


def test_repeats_are_aligned_again():
    assert aligned([1, 2, 9, 1, 2, 8, 1, 2], [5, 1, 2, 6]) == [0, 1, 3, 4, 6, 7]
    assert aligned([1, 9, 1], [1, 1, 1], 2, [False] * 3) == []


def test_patience_decides_what_goes(monkeypatch):
    """Without anchors the rest of the alignment deletes other lines."""
    draw = random.Random(2)
    cases = [([draw.randrange(9) for _ in range(12)], [draw.randrange(9) for _ in range(12)]) for _ in range(500)]
    before = [aligned(a, b, 2, [False] * 12) for a, b in cases]
    monkeypatch.setattr(line_dedup, "_anchors", lambda *_: [])
    assert sum(aligned(a, b, 2, [False] * 12) != old for (a, b), old in zip(cases, before)) > 25
    monkeypatch.setattr(line_dedup, "matches", lambda *_: [])
    assert not any(aligned(a, b, 2, [False] * 12) for a, b in cases)


def test_long_documents_without_a_unique_line():
    draw = random.Random(1)
    later, earlier = ([draw.randrange(50) for _ in range(3000)] for _ in range(2))
    found = matches(later, earlier)
    assert len(found) > 600
    assert aligned([7] * 50_000, [7] * 40_000) == list(range(50_000))


def line(seed, count=8):
    return " ".join(words(seed, count))


def cleaned(spark, texts, **options):
    docs = documents(spark, texts, clashing=True)
    rows = line_dedup.drop_repeated_lines(docs, **options).select("row.*", "cleaned").drop(*[])
    return rows


def result(spark, texts, **options):
    docs = documents(spark, texts, clashing=True)
    found = line_dedup.drop_repeated_lines(docs, **options).select("row.doc_id", "gone", "cleaned").collect()
    return {r["doc_id"]: (r["gone"], r["cleaned"]) for r in found}


def test_blocks_go_from_the_later_document(spark):
    block = [line(k) for k in range(4)]
    texts = [
        "\n".join(["start", *block, "end"]),
        "\n".join(["own", "", *block[:2], "", "  " + block[2] + "\t", "tail"]),
        "\n".join([block[1], "between", line(99, 25)]),  # one short line alone stays
        "\n".join(["x", line(99, 25), "y"]),  # one long line goes
        None,
        "",
        "\n \n",
    ]
    found = result(spark, texts)
    assert found[0] == ([], texts[0])
    assert found[1] == ([2, 3, 5], "own\n\n\ntail")
    assert found[2] == ([], texts[2])
    assert found[3] == ([1], "x\ny")
    assert found[4] == ([], None) and found[5] == ([], "") and found[6] == ([], "\n \n")


def test_copies_and_near_copies_of_a_large_group(spark):
    body = [line(k, 25) for k in range(6)]
    texts = ["\n".join(body)] * 40 + ["\n".join([*body[:3], line(100 + k, 25), *body[3:]]) for k in range(40)]
    found = result(spark, texts, rare=3)
    assert found[0] == ([], texts[0])
    assert all(found[k][1] == "" for k in range(1, 40))
    assert all(found[40 + k][1] == line(100 + k, 25) for k in range(40))


def test_repeated_rows_and_null_ids(spark):
    text = "\n".join(line(k, 25) for k in range(3))
    rows = [(4, text), (4, text), (None, text), (9, text + "\nnew")]
    found = line_dedup.drop_repeated_lines(documents(spark, rows)).select("row.doc_id", "cleaned").collect()
    got = sorted((str(r["doc_id"]), r["cleaned"]) for r in found)
    assert got == [("4", text), ("4", text), ("9", "new"), ("None", "")]


def test_every_qualifying_line_that_stands_earlier_goes(spark):
    """Long lines, each once in a document and in one order: brute force is membership."""
    draw = random.Random(3)
    pool = [line(k, 22) for k in range(60)]
    chosen = [sorted(draw.sample(range(60), draw.randint(1, 12))) for _ in range(50)]
    found = result(spark, ["\n".join(pool[k] for k in c) for c in chosen], rare=2)
    seen = set()
    for k, lines in enumerate(chosen):
        assert found[k][1].split("\n") == ([pool[j] for j in lines if j not in seen] or [""])
        seen |= set(lines)


def test_empty_table(spark):
    assert line_dedup.drop_repeated_lines(documents(spark, []).limit(0)).count() == 0


def test_header_and_footer_both_go(spark):
    """A block twice in the later text, twice in the earlier, and blocks in another order."""
    block, other = [line(1), line(2)], [line(3), line(4)]
    texts = [
        "\n".join([*block, "a", *other]),
        "\n".join([*block, "b", *block]),
        "\n".join([*other, "c", *block]),
        "\n".join([line(5, 25), "d", line(5, 25)]),
        "\n".join(["e", line(5, 25)]),
    ]
    found = result(spark, texts)
    assert [found[k][1] for k in (0, 1, 3, 4)] == [texts[0], "b", texts[3], "e"]
    assert found[2][1] in ("\n".join([*other, "c"]), "\n".join(["c", *block]))


def test_documents_that_kept_a_run_are_tried_with_each_other(spark):
    """Many documents have two blocks in the order that the first has not: only the second keeps one."""
    one, two = [line(k, 25) for k in range(3)], [line(k, 25) for k in range(3, 6)]
    texts = ["\n".join([*one, "first", *two])] + ["\n".join([*two, f"own {k}", *one]) for k in range(12)]
    found = result(spark, texts)
    assert len(found[1][0]) == 3
    assert all(found[k][1] == f"own {k - 1}" for k in range(2, 13))


def brute_gone(texts, rare=16, min_words=20, min_lines=2):
    """Places of the lines that go from each text, by the same rule over plain lists; and those of all pairs."""
    split = [[s.strip(" \t\r\x0b\x0c") for s in (t or "").split("\n")] for t in texts]
    places = [[k for k, s in enumerate(own) if re.search(r"[^\x20\x09-\x0D]", s)] for own in split]
    lines = [[own[k] for k in at] for own, at in zip(split, places)]
    long = [[len(re.findall(r"[^\x20\x09-\x0D]+", s)) >= min_words for s in own] for own in lines]
    first_of = {}
    leaders = [k for k, own in enumerate(lines) if own and first_of.setdefault(tuple(own), k) == k]

    def keys(k, gone):
        own = lines[k]
        for size in range(1, min_lines + 1):
            for at in range(len(own) - size + 1):
                if (size == min_lines or any(long[k][at : at + size])) and not all(p in gone for p in range(at, at + size)):
                    yield tuple(own[at : at + size])

    def holders(found):
        table = {}
        for k, key in found:
            table.setdefault(key, set()).add(k)
        return {key: sorted(have) for key, have in table.items() if len(have) > 1}

    gone = {k: set() for k in leaders}
    everything = {k: set() for k in leaders}
    for k in leaders:
        for other in leaders[: leaders.index(k)]:
            everything[k].update(aligned(lines[k], lines[other], min_lines, long[k]))
    open_ = holders({(k, key) for k in leaders for key in keys(k, set())})
    pairs = {(k, have[0]) for have in open_.values() for k in have[1:]}
    for have in holders({(k, s) for k in leaders for s in lines[k]}).values():
        if len(have) <= rare:
            pairs |= {(k, have[0]) for k in have[1:]} | set(zip(have[1:], have))
    tried = set()
    while open_:
        for k, other in pairs - tried:
            gone[k].update(aligned(lines[k], lines[other], min_lines, long[k]))
        tried |= pairs
        kept = {k: set(keys(k, gone[k])) for k in leaders}
        open_ = holders({(k, key) for key, have in open_.items() for k in have[1:] if key in kept[k]})
        pairs = {(k, have[0]) for have in open_.values() for k in have[1:]}
    result = []
    for k, own in enumerate(lines):
        whole = own and first_of[tuple(own)] != k and (len(own) >= min_lines or any(long[k]))
        result.append({places[k][p] for p in (range(len(own)) if whole else gone.get(k, ()))})
    return result, sum(map(len, gone.values())), sum(map(len, everything.values()))


def test_result_is_that_of_the_rule_and_near_that_of_all_pairs(spark):
    draw = random.Random(5)
    pool = [line(k, 22 if k < 3 else 5) for k in range(14)]
    texts = ["\n".join(draw.choices(pool, k=draw.randint(1, 9))) for _ in range(45)]
    for min_lines in (2, 3):
        found = result(spark, texts, rare=2, min_lines=min_lines)
        expected, some, everything = brute_gone(texts, rare=2, min_lines=min_lines)
        assert [set(found[k][0]) for k in range(len(texts))] == expected
        assert some >= 0.9 * everything


def test_recall_of_all_pairs_on_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    expected, some, everything = brute_gone([r["text"] for r in rows])
    found = line_dedup.drop_repeated_lines(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    gone = {r["doc_id"]: set(r["gone"]) for r in found.select("row.doc_id", "gone").collect()}
    assert [gone[r["doc_id"]] for r in rows] == expected
    assert some >= 0.97 * everything


def test_very_long_text(spark):
    body = [line(k, 4) for k in range(20_000)]
    texts = ["\n".join(body), "\n".join(["new", *body, "other"])]
    assert result(spark, texts)[1][1] == "new\nother"


def test_holders_after_the_earliest_count(spark):
    """The earliest holder of the long line has it twice, and has not the short line beside it."""
    long, short = line(1, 25), line(2)
    texts = ["\n".join([long, "a", long]), *("\n".join([f"b{k}", long, short, f"c{k}"]) for k in range(6))]
    for min_lines in (2, 3):
        found = result(spark, texts, min_lines=min_lines)
        assert [set(found[k][0]) for k in range(7)] == brute_gone(texts, min_lines=min_lines)[0]
        assert all(long not in found[k][1] for k in range(1, 7))
