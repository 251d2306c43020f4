import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, words
from tokenizers import Tokenizer

from splitmetrics.llm import packing
from splitmetrics.llm.tokens import token_ids

EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*EXACT.encode(text or "", add_special_tokens=False).ids, 1]


@settings(deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80))
def test_tournament_tree_is_first_fit(sizes):
    fit, bins = packing.FirstFit(100, len(sizes)), []
    for size in sizes:
        k = next((k for k, used in enumerate(bins) if used + size <= 100), len(bins))
        bins[k:] = [*bins[k:], 0] if k == len(bins) else bins[k:]
        assert fit.place(size) == (k, bins[k])
        bins[k] += size


@settings(deadline=None)
@given(st.text() | st.text(alphabet=" \t\n\x0b\x1c\x1f\x85  'sreABé1²<|endoftext|>"))
def test_ids_are_those_of_tokenizers(text):
    assert token_ids(text).tolist() == ids_of(text)[:-1]


def test_special_token_in_a_text():
    text = "a <|endoftext|>b<|endoftext|>"
    assert token_ids(text).tolist() == ids_of(text)[:-1]


def check(rows, texts, capacity):
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_document[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by_document.keys() == texts.keys()
    for k, parts in by_document.items():
        ids = np.array(ids_of(texts[k]), "<u4")
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            part = ids[at : at + p["length"]]
            assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += p["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pieces_lie_gapless_and_once(spark):
    texts = {k: " ".join(words(k, 7 * k + 1)) for k in range(60)} | {60: None, 61: "", 62: "x" * 9000}
    found = packing.pack_documents(documents(spark, list(texts.items()), clashing=True), capacity=256, group_pieces=40).collect()
    sequences = check(found, texts, 256)
    assert sequences <= 1.1 * sum(len(ids_of(t)) for t in texts.values()) / 256 + 5


def test_repeated_rows_and_null_ids(spark):
    found = packing.pack_documents(documents(spark, [(1, "a b"), (1, "a b"), (None, "c"), (None, "c")])).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "None", "None"]
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == 4


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, []).limit(0)).count() == 0
