"""Token ids in training order: shards of fixed-stride records that are read in sequence.

Documents are tokenised and cut into sequences of at most ``length`` ids. A document at row r of its
file, in a file before which n rows lie, has number n + r; its k-th sequence has the number
(n + r) * most + k, where ``most`` is the most that any document could have, by its bytes. A keyed Feistel
network with cycle-walking permutes these numbers. The slots of numbers that no sequence has are closed up, so the global slots are 0, 1, 2 and so on in
the permuted order.

The permuted numbers are cut into equal ranges, one for each shard; as the permutation spreads them
evenly, shards are of like size whatever the documents are. A shard is sorted and written as one
file by one task, under a name of its attempt that becomes the final name when it is whole; so
lost executors and tasks that run twice leave the same files. Text is tokenised once and its ids are shuffled once.

A record has ``16 + width * length`` bytes: doc_id (signed 64-bit), the number of the document's ids before it and the number of ids (unsigned
32-bit, the latter with the top bit set where doc_id is null), then the ids, padded with zeros. ``width`` is two where the vocabulary allows it, else four. All numbers are
little-endian. ``manifest`` says at which slot each shard begins.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import cache
from uuid import uuid4

import numpy as np
import pyarrow.fs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from splitmetrics.llm.rows import map_rows
from splitmetrics.llm.tokens import VOCABULARY, token_ids, vocabulary_size
from splitmetrics.sources.workspace import new_path, stage

_ROUNDS = 6
_HEADER = np.dtype([("doc_id", "<i8"), ("start", "<u4"), ("count", "<u4")])
_NULL_ID = 1 << 31


class Permutation:
    """A keyed permutation of the numbers below ``size``."""

    def __init__(self, size: int, key: int):
        self.size, self.key = size, key
        self.half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1

    def _mixed(self, k: int, value: int) -> int:
        return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), (self.key + k) % (1 << 64)) & self.mask

    def __call__(self, number: int) -> int:
        """Walk on until the network leads back below ``size``; under four steps on average."""
        while True:
            left, right = number >> self.half, number & self.mask
            for k in range(_ROUNDS):
                left, right = right, left ^ self._mixed(k, right)
            number = left << self.half | right
            if number < self.size:
                return number

    def inverse(self, number: int) -> int:
        while True:
            left, right = number >> self.half, number & self.mask
            for k in reversed(range(_ROUNDS)):
                left, right = right ^ self._mixed(k, left), left
            number = left << self.half | right
            if number < self.size:
                return number


@dataclass(frozen=True)
class Layout:
    """How records lie in the shards of a folder."""

    length: int
    width: int

    @property
    def record(self) -> np.dtype:
        return np.dtype([("head", _HEADER), ("ids", f"<u{self.width}", (self.length,))])


def _is_scan(documents: DataFrame) -> bool:
    """Whether every row is one row of a file: a scan, with nothing but filters and columns above."""
    plan = documents._jdf.queryExecution().optimizedPlan().toString()
    steps = [line.lstrip(" :+-").split(" ")[0].split("[")[0] for line in plan.splitlines() if line.strip()]
    return steps[-1] == "Relation" and set(steps) <= {"Project", "Filter", "Relation"}


def _numbered(documents: DataFrame) -> tuple[DataFrame, int]:
    """The documents with a ``number`` of their own, below the number of rows that is returned.

    Rows are numbered by their place in their files, which no retry changes; a frame that is more than a scan of
    files is written to the shared folder first. A file's first number is a running sum over the files, which
    stay on the cluster.
    """
    columns = ["doc_id", "text"]
    if not _is_scan(documents):
        documents = stage(documents.select(*columns), "numbered")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index")]
    placed = documents.select(*columns, *place)
    sizes = placed.groupBy("file").agg((F.max("row_index") + 1).alias("rows"))
    upto = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, 0)
    files = sizes.withColumn("past", F.sum("rows").over(upto))
    files = stage(files.select("file", (F.col("past") - F.col("rows")).alias("before"), "past"), "files")
    number = (F.col("before") + F.col("row_index")).alias("number")
    return placed.join(files, "file").select(number, *columns), files.agg(F.max("past")).first()[0] or 0


def _folder(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


def shard_name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def write_shards(
    documents: DataFrame,
    folder: str,
    length: int = 256,
    key: int = 1,
    end_id: int | None = None,
    vocabulary: str = VOCABULARY,
    shard_bytes: int = 16 << 20,
) -> DataFrame:
    """Write the shards below ``folder``; return their manifest, a row for each in order.

    Columns: shard, path, first_slot, records, crc32. ``end_id``, if given, is added to the end of
    every document. A document without ids has one record without any; so null and empty texts, repeated rows and
    null ids all keep their place. An empty table gives no shard and an empty manifest. ``folder`` is a path or URI that
    executors can write to.
    """
    placed, rows = _numbered(documents)
    size = F.octet_length(F.coalesce("text", F.lit("")))
    total, longest = placed.agg(F.sum(size), F.max(size)).first()
    most = (longest or 0) // length + 2  # a token has a byte at least, and the end id may be one more
    permute = Permutation(max(1, rows * most), key)
    layout = Layout(length, 2 if vocabulary_size(vocabulary) <= 1 << 16 else 4)
    # By a likely four bytes to a token; only the size of files depends on it.
    expected = (total or 0) // 4 * layout.width + rows * 16
    shards = max(1, expected // shard_bytes)
    tail = [] if end_id is None else [end_id]

    def sequences(source: Iterator[tuple]) -> Iterator[tuple]:
        for number, doc_id, text in source:
            ids = np.append(token_ids(text, vocabulary), np.array(tail, "<u4")).astype(f"<u{layout.width}")
            for k, start in enumerate(range(0, max(1, len(ids)), length)):
                order = permute(number * most + k)
                yield order * shards // permute.size, order, doc_id, start, ids[start : start + length].tobytes()

    cut = map_rows(placed, sequences, "shard int, place long, doc_id long, start long, ids binary")
    dealt = cut.repartitionById(shards, "shard").sortWithinPartitions("shard", "place")

    def write(source: Iterator[tuple]) -> Iterator[tuple]:
        files, root = _folder(folder)
        current: _Shard | None = None
        for shard, _, doc_id, start, ids in source:
            if current is None or current.number != shard:
                if current is not None:
                    yield current.close()
                current = _Shard(files, root, folder, shard, layout)
            current.add(doc_id, start, ids)
        if current is not None:
            yield current.close()

    files, root = _folder(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/layout.json") as out:
        out.write(json.dumps(asdict(layout)).encode())
    written = map_rows(dealt, write, "shard int, path string, records long, crc32 long")
    return _manifest(stage(written, "shards"))


def _manifest(written: DataFrame) -> DataFrame:
    """Where each shard begins: running sums over a row for each shard."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("records").over(before), F.lit(0)).alias("first_slot")
    return written.select("shard", "path", first, "records", "crc32")


class _Shard:
    """A file that is written under a name of its own and renamed when it is whole."""

    def __init__(self, files, root: str, folder: str, number: int, layout: Layout):
        self.files, self.number, self.layout = files, number, layout
        self.final = f"{root}/{shard_name(number)}"
        self.path = f"{folder.rstrip('/')}/{shard_name(number)}"
        self.temporary = f"{self.final}.{uuid4().hex}"
        files.create_dir(root, recursive=True)
        self.stream = files.open_output_stream(self.temporary)
        self.records, self.crc = 0, 0

    def add(self, doc_id: int | None, start: int, ids: bytes) -> None:
        count = len(ids) // self.layout.width
        flags = _NULL_ID if doc_id is None else 0
        head = np.array((doc_id or 0, start, count | flags), _HEADER).tobytes()
        record = head + ids.ljust(self.layout.width * self.layout.length, b"\0")
        self.stream.write(record)
        self.crc = zlib.crc32(record, self.crc)
        self.records += 1

    def close(self) -> tuple:
        self.stream.close()
        self.files.move(self.temporary, self.final)
        return self.number, self.path, self.records, self.crc


def open_records(path: str, layout: Layout, first: int = 0, block: int = 4096) -> Iterator[np.ndarray]:
    """Blocks of records of one shard from record ``first`` on."""
    files, at = _folder(path)
    stride = layout.record.itemsize
    with files.open_input_file(at) as file:
        file.seek(first * stride)
        while data := file.read(block * stride):
            yield np.frombuffer(data, layout.record)


@cache
def read_layout(folder: str) -> Layout:
    files, root = _folder(folder)
    with files.open_input_file(f"{root}/layout.json") as file:
        return Layout(**json.loads(file.read()))


def resume(manifest: list, layout: Layout, slot: int) -> Iterator[tuple[int, np.ndarray]]:
    """The ids of every sequence from ``slot`` on, in order; ``manifest`` is its collected rows."""
    for row in sorted(manifest, key=lambda r: r["first_slot"]):
        skip = max(0, slot - row["first_slot"])
        if skip >= row["records"]:
            continue
        at = row["first_slot"] + skip
        for records in open_records(row["path"], layout, skip):
            for record in records:
                yield at, record["ids"][: int(record["head"]["count"]) & (_NULL_ID - 1)]
                at += 1


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """What the files hold: slot, shard, doc_id, start, length and ids_crc32 of every record.

    The checksum is that of the ids as little-endian unsigned 32-bit integers.
    """
    layout = read_layout(folder)

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for shard, path, slot in rows:
            for records in open_records(path, layout):
                for head, ids in zip(records["head"].tolist(), records["ids"], strict=True):
                    doc_id, start, count = head
                    length = count & (_NULL_ID - 1)
                    crc = zlib.crc32(ids[:length].astype("<u4").tobytes())
                    yield slot, shard, None if count & _NULL_ID else doc_id, start, length, crc
                    slot += 1

    schema = "slot long, shard int, doc_id long, start long, length long, ids_crc32 long"
    spread = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("shard", "path", "first_slot").repartition(spread, "shard")
    return map_rows(files, read, schema)


def training_order(spark: SparkSession, documents: DataFrame, **options) -> DataFrame:
    """Write the shards to a new folder in the shared one and read them back."""
    folder = new_path(spark, "token_shards")
    manifest = stage(write_shards(documents, folder, **options), "manifest")
    return read_shards(manifest, folder)
