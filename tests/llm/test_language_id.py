import itertools
import zlib

import pytest
from pyspark.sql import functions as F
from tables import documents

from splitmetrics.llm import language_id

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    return docs, language_id.fit(docs, ~language_id.held_out())


def test_held_out_accuracy(spark, trained):
    docs, model = trained
    found = language_id.identify(docs, model).where(language_id.held_out())
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 150
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert right >= 0.97 * len(rows), (right, len(rows))
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_folds_are_those_of_the_checksum(spark):
    frame = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("held", language_id.held_out())
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in frame.collect())


def test_machines_tell_languages_of_a_family_apart(trained):
    _, model = trained
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert set(model.pair_weights) == {("de", "en"), ("es", "fr")}


def test_undetermined(spark, trained):
    texts = [None, "", "12 34 !?", "٣ ²", "a", "über", "x" * 100_000, "the\n" * 3]
    found = language_id.identify(documents(spark, texts, clashing=True), trained[1]).orderBy("doc_id").collect()
    assert [r["lang_pred"] == "und" for r in found] == [True] * 4 + [False] * 4
    assert all(r["score"] == 0 for r in found[:4])


def test_rejected_documents_go_with_their_rows(spark, trained):
    docs, model = trained
    some = docs.limit(50).unionByName(documents(spark, [(1, None), (None, "..."), (2, "")]))
    kept = language_id.keep_identified(some, model)
    assert kept.columns == docs.columns and kept.count() == 50


def test_prediction_depends_on_text_only(spark, trained):
    docs, model = trained
    some = docs.limit(40)
    other = some.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": -F.col("doc_id")})
    one = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(some, model).collect()}
    two = {-r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(other, model).collect()}
    assert one == two


def test_nothing_to_learn_from(spark):
    docs = documents(spark, ["a text", None]).withColumn("lang", F.lit(None).cast("string"))
    model = language_id.fit(docs, F.lit(True))
    assert {r["lang_pred"] for r in language_id.identify(docs, model).collect()} == {"und"}
    empty = docs.limit(0)
    assert language_id.identify(empty, language_id.fit(empty, F.lit(True))).count() == 0


def test_unknown_languages_are_families_of_their_own(spark):
    rows = [(k, f"{w} " * 20) for k, w in enumerate(["zog blik", "mnu orfa"] * 20)]
    docs = documents(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "q1").otherwise("q2"))
    model = language_id.fit(docs, F.lit(True))
    found = language_id.identify(docs, model).collect()
    assert all(r["lang_pred"] == ("q1" if r["doc_id"] % 2 == 0 else "q2") for r in found)


def test_no_language_is_left_out(spark):
    """More languages than any list of common ones; each has words of its own."""
    rows = [(lang * 100 + k, " ".join(f"{chr(97 + lang % 26)}{chr(97 + lang // 26)}{w}" for w in ("ka", "to", "mi", "su")), f"l{lang:02d}") for lang in range(90) for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for limits in ({}, {"sample_rows": 300}):
        model = language_id.fit(docs, F.lit(True), **limits)
        found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, model).collect()}
        assert sum(found[i] == lang for i, _, lang in rows) >= 0.98 * len(rows)
        assert len(set(found.values())) == 90


def test_predictions_equal_those_of_the_weights(spark):
    """A second computation of family shares and pairwise votes, by plain loops."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs, ~language_id.held_out())
    found = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    for row in docs.select("doc_id", "text").collect():
        text = row["text"]
        if not text or not any(map(str.isalpha, text)):
            assert found[row["doc_id"]]["lang_pred"] == "und"
            continue
        x = [*language_id.features(text).astype(float), 1.0]
        raw = [sum(a * b for a, b in zip(w, x)) for w in model.family_weights.astype(float)]
        members = model.languages[model.families[raw.index(max(raw))]]
        votes = {}
        for a, b in itertools.combinations(members, 2):
            margin = sum(p * q for p, q in zip(model.pair_weights[a, b].astype(float), x))
            for lang, sign in ((a, 1), (b, -1)):
                n, total = votes.get(lang, (0, 0.0))
                votes[lang] = (n + (margin >= 0) if sign == 1 else n + (margin < 0), total + sign * margin)
        best = max(members, key=lambda k: votes.get(k, (0, 0.0)))
        assert found[row["doc_id"]]["lang_pred"] == best


def test_clean_texts_stay_whatever_their_score(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs, ~language_id.held_out())
    texts = ["the", "la", "der die", "el los la le", "x", "the la der el of de und y"]
    short = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert language_id.keep_identified(short, model).count() == len(texts)
