"""Each stage on what the one before it kept, against brute force."""

import pytest
from tables import documents
from test_line_dedup import brute_gone
from test_packing import check
from test_simhash import brute_components, brute_fingerprint
from test_suffix_dedup import WORD, brute_spans

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


def brute_lines(rows):
    """Texts after the removal of aligned blocks, by the rule over plain lists."""
    order = sorted(rows)
    gone, _, _ = brute_gone([text for _, text in order])
    return {
        k: "\n".join(s for n, s in enumerate((text or "").split("\n")) if n not in lost) if lost else text
        for (k, text), lost in zip(order, gone, strict=True)
    }


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, function in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.stage(function(spark, docs[-1], FOLDER), "stage"))
    return docs


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_stages_keep_the_columns(stages):
    assert all(d.schema.names == stages[0].schema.names for d in stages[:5])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "suffix_array_dedup", "packing",
    ]


def test_documents_in_a_language_stay(stages):
    before, after = texts(stages[0]), texts(stages[1])
    rejected = set(before) - set(after)
    assert all(not any(map(str.isalpha, before[k] or "")) for k in rejected)
    assert all(before[k] == text for k, text in after.items())


def test_lines_go(stages):
    before, after = texts(stages[1]), texts(stages[2])
    assert set(before) == set(after)
    brute = brute_lines(list(before.items()))
    assert after == brute
    assert sum(after[k] != before[k] for k in after) > 5
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_one_of_each_near_duplicate_group_stays(stages):
    before, after = texts(stages[2]), texts(stages[3])
    prints = {k: brute_fingerprint(t) for k, t in before.items()}
    reach = brute_components(list(prints.values()), 2)
    kept = {min(j for j, p in prints.items() if p in reach[prints[k]]) for k in before}
    assert set(after) == kept and all(after[k] == before[k] for k in kept)


def test_repeated_passages_go(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    spans = brute_spans(sorted(before.items()), 50)
    for k, text in before.items():
        gone = {j for a, b in spans[k] for j in range(a, b)}
        rest = [w for j, w in enumerate(WORD.findall(text)) if j not in gone]
        assert WORD.findall(after[k]) == rest
        assert gone or after[k] == text


def test_all_is_packed(stages):
    check(stages[5].collect(), texts(stages[4]), 2048)


def test_run_applies_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    one, two = (sorted(map(tuple, f.select(*columns).collect())) for f in (found, stages[5]))
    assert one == two


def test_odd_rows_pass_through(spark):
    long = "the and of in to " * 9_000
    rows = [(1, None), (2, ""), (3, "12 34"), (None, "the same text of in and"), (5, long), (5, long), (6, "le la et des une")]
    docs = documents(spark, rows, clashing=True)
    for _, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, FOLDER), "odd")
    assert {r["doc_id"] for r in docs.collect()} >= {5, None}
    empty = documents(spark, [], clashing=True).limit(0)
    for _, function in corpus_pipeline.STAGES:
        empty = corpus_pipeline.stage(function(spark, empty, FOLDER), "empty")
    assert empty.count() == 0
