import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tables import documents, words

from splitmetrics.llm import fingerprints


def lines(text):
    return {line for line in (text or "").split("\n") if line.strip(" \t\n\x0b\x0c\r")}


def jaccard(a, b):
    a, b = lines(a), lines(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    order = sorted({(i is None, i, t) for i, t in rows if i is not None}, key=lambda k: k[1])
    following = {k: order[(n + 1) % len(order)] for n, k in enumerate(order)}
    out = []
    for doc_id, text in rows:
        own, nxt = text or "", following[doc_id is None, doc_id, text][2] or ""
        n = len(own)
        edited = own[: n - n // 2] + nxt[: n // 2]
        out.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), jaccard(own, edited), jaccard(own, nxt)))
    return sorted(out)


def corpus():
    draw = random.Random(8)
    texts = []
    for k in range(40):
        body = [" ".join(words(draw.randrange(10**6), 6)) for _ in range(draw.choice([0, 1, 3, 9, 20]))]
        texts.append("\n".join(body))
        if k % 5 == 0 and body:
            texts.append("\n".join([*body[:-1], "changed", "", body[0]]))
    return [*texts, None, "", "é\n🙂🙂🙂", "one\none\n \none", "\n".join(f"line {k}" for k in range(700)), "\n".join(f"line {k}" for k in range(650, 1500))]


@pytest.mark.parametrize("ranges", [16, 0.125])
def test_versions(spark, monkeypatch, ranges):
    monkeypatch.setattr(fingerprints, "_RANGES_PER_PARTITION", ranges)
    rows = [(3 * k, t) for k, t in enumerate(corpus())]
    rows += [rows[4], rows[4], rows[-1]]
    found = fingerprints.fingerprint_versions(documents(spark, rows, clashing=True)).collect()
    got = sorted((r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in found)
    assert [g[:3] for g in got] == [e[:3] for e in expected(rows)]
    assert [g[3:] for g in got] == [pytest.approx(e[3:]) for e in expected(rows)]
    texts = dict(rows)
    by_text = {}
    for r in found:
        assert by_text.setdefault(texts[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]
    assert len(set(by_text.values())) >= len({frozenset(lines(t)) for t in by_text}) > 30


def test_one_document_follows_itself(spark):
    row = fingerprints.fingerprint_versions(documents(spark, [(5, "ab\ncd\nefg")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"ab\ncdab\nc").hexdigest() and row["near_next"] == 1


def test_null_ids_come_last(spark):
    rows = [(None, "x\ny"), (1, "a\nb"), (None, "x\ny"), (0, None)]
    found = fingerprints.fingerprint_versions(documents(spark, rows)).orderBy("doc_id").collect()
    digest = [hashlib.sha256(t).hexdigest() for t in (b"x\n", b"x\n", b"", b"a\nx")]
    assert [r["edited_sha256"] for r in found] == digest


def test_peeling_recovers_or_says_so(spark):
    frame = spark.range(1, 60).select(
        F.transform(F.sequence(F.lit(1), "id"), lambda x: F.xxhash64(x)).alias("l"), F.transform(F.sequence(F.lit(40), F.lit(45)), lambda x: F.xxhash64(x)).alias("r"), "id"
    )
    cells = frame.select("id", F.expr(fingerprints.sketch("l")).alias("a"), F.expr(fingerprints.sketch("r")).alias("b"))
    for row in cells.select("id", F.expr(fingerprints.peeled("a", "b")).alias("found")).collect():
        left, right = set(range(1, row["id"] + 1)), set(range(40, 46))
        if row["found"]["ok"]:
            assert (row["found"]["only_left"], row["found"]["only_right"]) == (len(left - right), len(right - left))
        else:
            assert len(left ^ right) > 12


def test_no_python_in_the_plan(spark):
    plan = fingerprints.fingerprint_versions(documents(spark, ["a\nb", "c"]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_empty_table(spark):
    assert fingerprints.fingerprint_versions(documents(spark, []).limit(0)).count() == 0
