import os
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, words

from splitmetrics.llm import token_shards
from splitmetrics.llm.tokens import token_ids


@settings(deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**64))
def test_permutation(size, key):
    permute = token_shards.Permutation(size, key)
    numbers = [permute(k) for k in range(size)]
    assert sorted(numbers) == list(range(size))
    assert [permute.inverse(n) for n in numbers] == list(range(size))


def pieces(rows, length):
    out = []
    for doc_id, text in rows:
        ids = token_ids(text)
        for start in range(0, max(1, len(ids)), length):
            part = ids[start : start + length]
            out.append((str(doc_id), start, len(part), zlib.crc32(part.astype("<u4").tobytes())))
    return sorted(out)


def test_shards_hold_every_sequence_in_permuted_order(spark, tmp_path):
    rows = [(k, " ".join(words(k, 9 * k))) for k in range(60)]
    rows += [(60, None), (61, ""), (7, rows[7][1]), (None, "no id"), (None, "no id")]
    folder = str(tmp_path / "shards")
    docs = documents(spark, rows, clashing=True)
    manifest = token_shards.write_shards(docs, folder, length=16, shard_bytes=4000)
    listed = manifest.collect()
    found = token_shards.read_shards(manifest, folder).collect()
    assert pieces(rows, 16) == sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"]) for r in found)
    assert sorted(r["slot"] for r in found) == list(range(len(found)))
    assert len(listed) > 3
    files = sorted(f for f in os.listdir(folder) if f.startswith("shard-"))
    assert [os.path.basename(r["path"]) for r in listed] == files
    layout = token_shards.read_layout(folder)
    for r in listed:
        data = open(r["path"], "rb").read()
        assert len(data) == r["records"] * layout.record.itemsize and zlib.crc32(data) == r["crc32"]
    # Sequences of a document do not stay together.
    order = [r["doc_id"] for r in sorted(found, key=lambda r: r["slot"])]
    assert sum(a == b for a, b in zip(order, order[1:])) < len(order) / 4
    ids = [(s, x.tolist()) for s, x in token_shards.resume(listed, layout, 0)]
    assert [s for s, _ in ids] == list(range(len(found)))
    for slot in (1, 17, len(found) - 1, len(found)):
        assert [(s, x.tolist()) for s, x in token_shards.resume(listed, layout, slot)] == ids[slot:]


def test_the_same_key_gives_the_same_order(spark, tmp_path):
    path = str(tmp_path / "documents")
    documents(spark, [" ".join(words(k, 50)) for k in range(20)], partitions=2).write.parquet(path)

    def order(name, key, spread):
        docs = spark.read.parquet(path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", spread)
        manifest = token_shards.write_shards(docs, str(tmp_path / name), length=16, key=key)
        rows = token_shards.read_shards(manifest, str(tmp_path / name)).orderBy("slot").collect()
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        return [(r["doc_id"], r["start"]) for r in rows]

    assert order("a", 1, "128m") == order("b", 1, "1k") != order("c", 2, "128m")


def test_end_id_and_wide_ids(spark, tmp_path):
    manifest = token_shards.write_shards(documents(spark, ["a b", ""]), str(tmp_path), length=8, end_id=50256)
    ids = [x.tolist() for _, x in token_shards.resume(manifest.collect(), token_shards.read_layout(str(tmp_path)), 0)]
    assert sorted(ids) == sorted([[*token_ids("a b").tolist(), 50256], [50256]])
    assert np.dtype(token_shards.Layout(8, 4).record).itemsize == 48


def test_empty_table(spark, tmp_path):
    manifest = token_shards.write_shards(documents(spark, []).limit(0), str(tmp_path))
    assert manifest.collect() == []


def test_every_row_has_a_number_of_its_own(spark, tmp_path):
    """Whatever the frame is made of: a scan, a generator over one, a union, a join, rows in memory."""
    from pyspark.sql import functions as F

    path = str(tmp_path / "documents")
    documents(spark, [f"text {k}" for k in range(50)], partitions=4).write.parquet(path)
    docs = spark.read.parquet(path)
    frames = {
        "scan": (docs, 50),
        "filtered": (docs.where("doc_id % 3 = 0").select("text", "doc_id"), 17),
        "exploded": (docs.select("doc_id", F.explode(F.array("text", "text")).alias("text")), 100),
        "united": (docs.union(docs), 100),
        "joined": (docs.join(docs.select(F.col("doc_id").alias("other")), F.expr("doc_id % 10 = other % 10")), 250),
        "memory": (documents(spark, ["a", "b"]), 2),
        "nothing": (docs.where("doc_id < 0"), 0),
    }
    for name, (frame, rows) in frames.items():
        numbered, past = token_shards._numbered(frame)
        numbers = [r["number"] for r in numbered.collect()]
        assert len(set(numbers)) == len(numbers) == rows, name
        assert all(0 <= n < past for n in numbers), name
