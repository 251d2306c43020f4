import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, words
from tokenizers import Tokenizer

from splitmetrics.llm import bpe

EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(text):
    return EXACT.encode(text or "", add_special_tokens=False).ids


def ours(text):
    return np.frombuffer(bpe.encoder().encode(text), "<u4").tolist()


ODD = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ​ 'sreveABé1²Ⅷ٣漢字é🙂_-—"


@settings(max_examples=400, deadline=None)
@given(st.text() | st.text(alphabet=ODD) | st.text(alphabet="aeinorst ") | st.text(alphabet="a -="))
def test_ids_are_those_of_tokenizers(text):
    assert ours(text) == expected(text)
    assert bpe.encoder().decode(bpe.encoder().encode(text)) == EXACT.decode(expected(text), skip_special_tokens=False) == text


def test_runs_of_all_lengths():
    for n in range(1, 90):
        for unit in ("a", " ", "-", "=", "ab", "é", "\n"):
            assert ours(unit * n) == expected(unit * n)


def test_long_word_and_special_token():
    for text in ("x" * 20_000, "tion" * 5_000, "<|endoftext|>", " a<|endoftext|><|endoftext|>b", "<|endoftext"):
        assert ours(text) == expected(text)


def test_decoding_of_any_ids():
    for ids in ([0, 255, 50256], [300, 129, 130], list(range(100, 300))):
        assert bpe.encoder().decode(np.array(ids, "<u4").tobytes()) == EXACT.decode(ids, skip_special_tokens=False)


def test_documents(spark):
    texts = [None, "", " ", *(" ".join(words(k, 200)) for k in range(20)), "naïve\r\n\tÜber 12³ don't"]
    docs = documents(spark, [*enumerate(texts), (3, texts[3]), (None, "x")], clashing=True)
    found = bpe.round_trip_digests(docs).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        text = "x" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        ids = np.array(expected(text), "<u4")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.decode_documents(bpe.encode_documents(docs)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(r["doc_id"]), r["text"] or "") for r in docs.collect())


def test_empty_table(spark):
    assert bpe.round_trip_digests(documents(spark, []).limit(0)).count() == 0
