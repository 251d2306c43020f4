"""The corpus pipeline: language ID, line dedup, near-dedup, passage dedup, packing.

Every stage takes the documents that the one before it left and returns documents again, with the same
columns; the last returns the pieces of the packed sequences. Each result is written to the shared
folder and read back, so a lost executor costs a part of one stage.

Null texts and texts without a letter have no language and go in the first stage. A document whose
lines all stand in an earlier one is left with an empty text by the second; the third keeps one of
these. Repeated rows, null ids and columns besides ``doc_id``, ``text`` and ``lang`` are handled as the operators say.
``n_chars`` is the number of characters of the text as it is then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitmetrics.llm import language_id, line_dedup, packing, simhash, suffix_dedup
from splitmetrics.sources.workspace import Workspace, stage

#: The classifier and the alignment have no SQL form; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def _with_text(cleaned: DataFrame) -> DataFrame:
    """The documents' own columns from ``row``, with the cleaned text and its length."""
    row = F.col("row").withField("text", F.col("cleaned"))
    if "n_chars" in cleaned.schema["row"].dataType.names:
        kind = cleaned.schema["row"].dataType["n_chars"].dataType
        row = row.withField("n_chars", F.char_length("cleaned").cast(kind))
    return cleaned.select(row.alias("row")).select("row.*")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs, ~language_id.held_out())
    return language_id.keep_identified(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(line_dedup.drop_repeated_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(suffix_dedup.drop_repeated_passages(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before it staged is deleted as soon as nothing reads it.

    If a stage fails, nothing that was staged stays behind.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES:
        work, result = Workspace(spark), Workspace(spark)
        try:
            with work.active():
                found = function(spark, docs, sf_dir)
            with result.active():
                docs = stage(found, name)
        except BaseException:
            result.close()
            raise
        finally:
            work.close()
            if before is not None:
                before.close()
        before = result
    return docs
