"""What the operators share: rows in and out of Arrow batches, and the identity of a row.

A document is identified by its ``doc_id`` and a checksum of its text (``tag``), so that rows
with equal ids but different texts stay apart, and equal rows are one document. Null ids
are an id of their own. Only the columns that an operator names are read, so further columns,
whatever they are called, never meet those that it makes.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows and bytes of output that a task gathers before it hands them over, and bytes of input that are Python objects at once.
_ROWS_OUT = 4096
_BYTES = 4 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed but lies in the same place."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def tag(text: Column) -> Column:
    """A checksum of the text; that of a null differs from that of an empty text."""
    return F.coalesce(F.crc32(text), F.lit(-1)).cast("long")


def same_document(left: str, right: str) -> Column:
    """Join condition: the rows aliased ``left`` and ``right`` are the same document."""
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (
        F.col(f"{left}.tag") == F.col(f"{right}.tag")
    )


def identified(documents: DataFrame) -> DataFrame:
    """doc_id, tag and text of every document."""
    return documents.select("doc_id", tag(F.col("text")).alias("tag"), "text")


def with_rows(documents: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """Every document as a struct ``row``, beside what ``found`` has under its doc_id and tag."""
    rows = documents.select(F.struct("*").alias("row")).withColumn("tag", tag(F.col("row.text")))
    rows = rows.withColumn("doc_id", F.col("row.doc_id"))
    others = [F.col(f"r.{name}") for name in found.columns if name not in ("doc_id", "tag")]
    joined = rows.alias("l").join(found.alias("r"), same_document("l", "r"), how)
    return joined.select("l.row", *others)


def map_rows(
    frame: DataFrame, function: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str
) -> DataFrame:
    """Apply a generator over rows to every partition, moving the rows in Arrow batches.

    Rows reach ``function`` one at a time, as tuples in the order of the frame's columns. A task holds
    an Arrow batch and a few megabytes of Python objects, or one row if that is larger.
    """
    importable(frame.sparkSession)
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    long_columns = [k for k, field in enumerate(arrow) if not pa.types.is_primitive(field.type)]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in source:
                step = max(1, batch.num_rows * _BYTES // max(batch.nbytes, 1))
                for at in range(0, batch.num_rows, step):
                    columns = batch.slice(at, step).columns
                    yield from zip(*(column.to_pylist() for column in columns), strict=True)

        held: list[tuple] = []
        size = 0
        for row in function(rows()):
            held.append(row)
            size += sum(_size(row[k]) for k in long_columns)
            if len(held) >= _ROWS_OUT or size >= _BYTES:
                yield _batch(held, arrow)
                held, size = [], 0
        if held:
            yield _batch(held, arrow)

    return frame.mapInArrow(batches, fields)


def _size(value) -> int:
    """About how many bytes a value takes."""
    if isinstance(value, (str, bytes)):
        return len(value)
    if isinstance(value, dict):
        return sum(map(_size, value.values()))
    if isinstance(value, (list, tuple)) and value and not isinstance(value[0], (int, float)):
        return sum(map(_size, value))
    return 8 * len(value) if hasattr(value, "__len__") else 8


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)],
        schema=schema,
    )
