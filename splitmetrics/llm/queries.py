"""The registered queries, one for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitmetrics.llm import (
    bpe,
    cap_filters,
    centroids,
    chat_formatting,
    expected,
    fill_middle,
    fingerprints,
    language_id,
    line_dedup,
    packing,
    quality,
    simhash,
    suffix_dedup,
    token_shards,
)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def _digest(text: str):
    return F.sha2(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8"), 256)


def chat_formatting_query(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces that render every repaired conversation, in order of position."""
    return chat_formatting.format_conversations(
        spark.read.parquet(f"{folder}/conversations.parquet")
    )


def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 or more words that stand earlier go; the spans are of word numbers from 0."""
    found = suffix_dedup.drop_repeated_passages(_documents(spark, folder))
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>"))
    words = F.aggregate(spans, F.lit(0), lambda n, s: n + s["end"] - s["start"])
    written = F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"]))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.array_join(written, ",").alias("spans"),
        words.cast("long").alias("n_words_removed"),
        F.char_length("cleaned").cast("long").alias("n_chars_kept"),
        _digest("cleaned").alias("cleaned_sha256"),
    )


def line_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that align with an earlier document go; ``gone`` has their numbers from 0."""
    found = line_dedup.drop_repeated_lines(_documents(spark, folder))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "gone",
        F.char_length("cleaned").cast("long").alias("n_chars_kept"),
        _digest("cleaned").alias("cleaned_sha256"),
    )


def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_versions(_documents(spark, folder))


def language(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    model = language_id.fit(documents, ~language_id.held_out())
    found = language_id.identify(documents, model)
    return found.withColumn("held_out", language_id.held_out())


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    model = quality.fit(documents, spark.read.parquet(f"{folder}/labels.parquet"))
    return quality.judge(documents, model)


def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(_documents(spark, folder))
    return groups.select("doc_id", "fingerprint", "component_id")


def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip_digests(_documents(spark, folder))


def token_shards_query(spark: SparkSession, folder: str) -> DataFrame:
    """Shards are written below the shared folder, and what they hold is read back."""
    return token_shards.training_order(spark, _documents(spark, folder))


def packing_query(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, folder))


def centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{folder}/embeddings.parquet")
    return centroids.cluster_table(centroids.cluster_vectors(embeddings))


def fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(_documents(spark, folder)))


def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cap_filters.near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_formatting": chat_formatting_query,
        "op2_suffix_array_dedup": suffix_array_dedup,
        "op3_line_dedup": line_dedup_query,
        "op4_document_fingerprints": document_fingerprints,
        "op5_language_id": language,
        "op6_quality_rules": quality_rules,
        "op7_simhash_near_dedup": simhash_near_dedup,
        "op8_bpe_round_trip": bpe_round_trip,
        "op9_token_shards": token_shards_query,
        "op10_packing": packing_query,
        "op11_centroid_clustering": centroid_clustering,
        "op12_fill_in_middle": fill_in_middle,
        "op13_embedding_near_dedup": embedding_near_dedup,
    }


# Every window of 50 words whose words stand before, by the texts themselves. A piece is a word with
# the white space after it, so a text is its leading white space and its pieces.
_REPEATED_PASSAGES = r"""
with pieces as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') as piece
  from documents
),
numbered as (select doc_id, unnest(piece) as piece, unnest(range(len(piece))) as k from pieces),
windows as (
  select doc_id, k,
    array_to_string(list_transform(piece[k + 1 : k + 50], lambda p: regexp_extract(p, '^[^\x20\x09-\x0D]+')), ' ') as passage
  from (select doc_id, piece, unnest(range(greatest(len(piece) - 49, 0))) as k from pieces)
),
repeated as (
  select doc_id, k from (
    select doc_id, k, row_number() over (partition by passage order by doc_id, k) as n from windows)
  where n > 1
),
covered as (select distinct doc_id, k + unnest(range(50)) as k from repeated),
runs as (
  select doc_id, min(k) as first, max(k) + 1 as past
  from (select doc_id, k, k - row_number() over (partition by doc_id order by k) as run from covered)
  group by doc_id, run
),
spans as (
  select doc_id, string_agg(concat(first, '-', past), ',' order by first) as spans,
    sum(past - first) as gone
  from runs group by doc_id
),
kept as (
  select n.doc_id, string_agg(piece, '' order by n.k) as rest
  from numbered n where not exists (
    select 1 from covered c where c.doc_id = n.doc_id and c.k = n.k)
  group by n.doc_id
),
cleaned as (
  select p.doc_id, coalesce(s.spans, '') as spans, cast(coalesce(s.gone, 0) as bigint) as gone,
    concat(regexp_extract(p.text, '^[\x20\x09-\x0D]*'), coalesce(k.rest, '')) as cleaned
  from pieces p left join spans s on s.doc_id = p.doc_id left join kept k on k.doc_id = p.doc_id
)
select doc_id, spans, gone as n_words_removed, cast(length(cleaned) as bigint) as n_chars_kept,
  sha256(cleaned) as cleaned_sha256
from cleaned"""


def oracle_sql() -> dict[str, str]:
    """Expected results, where DuckDB can compute them."""
    return {
        "op2_suffix_array_dedup": _REPEATED_PASSAGES,
        "op11_centroid_clustering": expected.CENTROID_CLUSTERING,
        "op12_fill_in_middle": expected.FILL_IN_MIDDLE,
        "op13_embedding_near_dedup": expected.EMBEDDING_NEAR_DEDUP,
    }
