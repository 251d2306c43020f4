"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint of 64 bits is cut into ``2 * bits + 1`` segments on a ring. If two fingerprints
differ in at most ``bits`` bits, some segment starts a chain in which the differences of the first
l segments, for every l, are at most ``l * bits / segments``. For the first two segments that is
less than one bit, so they are equal: each fingerprint goes to one bucket for each start, by two
segments. Pairs of a bucket must pass the whole chain before the Hamming distance is taken.

A bucket of more than ``pair_limit`` different fingerprints would make too many pairs. Its members agree in the
bits of the bucket, so they differ in at most ``bits`` of the other bits: these are cut into a ring of as many
segments again, and the members go to new buckets by two of them, until buckets are small. Each ring is a pigeonring
of its own, so no pair is lost, at any distance. A bucket with at most ``2 * bits`` bits left
has no more than ``4 ** bits`` members, whatever the data, and is compared as it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitmetrics.llm.graph import connected_components
from splitmetrics.llm.rows import identified, map_rows, with_rows
from splitmetrics.sources.workspace import stage

_SEED = 42
_WIDTH = 64


def fingerprint(text: str | None, words: int = 3) -> int:
    """The SimHash of a text as an unsigned integer: zero without a word."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    size = min(words, len(parts))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - size + 1].tolist()
    stops = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], _SEED) for a, b in zip(starts, stops, strict=True)),
        np.uint64,
        len(starts),
    )
    counts = np.zeros(_WIDTH, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, _WIDTH)
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(k) for k in np.flatnonzero(2 * counts > len(hashes)))


def fingerprints(documents: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, tag and fingerprint (the 64 bits as a long) of every document."""

    def compute(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, tag, text in rows:
            value = fingerprint(text, words)
            yield doc_id, tag, value - (1 << _WIDTH) if value >> 63 else value

    return map_rows(identified(documents), compute, "doc_id long, tag long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << _WIDTH) if mask >> 63 else mask


def ring(bits: int) -> list[int]:
    """The masks of the segments, as signed 64-bit integers."""
    segments = 2 * bits + 1
    cuts = [_WIDTH * k // segments for k in range(segments + 1)]
    return [_signed((1 << high) - (1 << low)) for low, high in zip(cuts, cuts[1:], strict=False)]


def _ring_of(fixed: str, bits: int) -> Column:
    """The masks of the segments into which the bits outside ``fixed`` are cut, as ``ring`` cuts all bits."""
    segments = 2 * bits + 1
    free = f"filter(sequence(0, {_WIDTH - 1}), i -> getbit(~{fixed}, i) = 1)"
    part = f"slice(free, cast(size(free) * k div {segments} as int) + 1, cast(size(free) * (k + 1) div {segments} - size(free) * k div {segments} as int))"
    mask = f"aggregate({part}, 0L, (m, i) -> m | shiftleft(1L, i))"
    return F.expr(f"transform(array({free}), free -> transform(sequence(0, {segments - 1}), k -> {mask}))[0]")


def _dealt(members: DataFrame, masks: Column, segments: int) -> DataFrame:
    """fp, fixed and, for every start, the ``key`` of the bucket and the bits ``within`` that it fixes."""
    two = F.transform(
        F.sequence(F.lit(0), F.lit(segments - 1)),
        lambda k: F.get("masks", k).bitwiseOR(F.get("masks", (k + 1) % segments)).bitwiseOR(F.col("fixed")),
    )
    placed = members.withColumn("masks", masks).select("fp", "fixed", F.posexplode(two).alias("start", "within"))
    return placed.withColumn("key", F.col("fp").bitwiseAND(F.col("within")))


def _differences(mask: Column | int) -> Column:
    return F.bit_count(F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(mask))


def _chained(masks: Column, bits: int) -> Column:
    """The chain from ``start`` keeps the budget of each of its lengths."""
    segments = 2 * bits + 1
    total, passed = F.lit(0), F.lit(True)
    for length in range(segments):
        total = total + _differences(F.get(masks, (F.col("start") + length) % segments))
        passed = passed & (total <= (length + 1) * bits // segments)
    return passed


def links(distinct: DataFrame, bits: int = 2, pair_limit: int = 64) -> DataFrame:
    """Edges ``a, b`` between what ``fp`` of ``distinct`` differs in at most ``bits`` bits; every such pair, once."""
    segments, bucket = 2 * bits + 1, ["fixed", "start", "key"]
    members = distinct.select("fp", F.lit(0).cast("long").alias("fixed"))
    masks, found = F.array(*map(F.lit, ring(bits))), []
    while True:
        dealt = _dealt(members, masks, segments)
        # Staged, as Spark splits a bucket with very many members only in a join of two tables.
        sizes = stage(dealt.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1"), "bucket_sizes")
        shared = stage(dealt.join(sizes, bucket), "buckets")
        crowded = (F.col("size") > pair_limit) & (F.bit_count(F.bitwise_not("within")) > 2 * bits)
        small = shared.where(~crowded)
        pairs = small.withColumnRenamed("fp", "x").join(
            small.select(*bucket, F.col("fp").alias("y")), bucket
        )
        near = pairs.where("x < y").where(_chained(masks, bits)).where(_differences(F.lit(-1)) <= bits)
        found.append(near.select(F.col("x").alias("a"), F.col("y").alias("b")))
        # Different ways may lead to the same bits; what is split on is then the same as well.
        members = shared.where(crowded).select("fp", F.col("within").alias("fixed")).distinct()
        if members.isEmpty():
            return reduce(DataFrame.union, found).distinct()
        masks = _ring_of("fixed", bits)


def components(prints: DataFrame, bits: int = 2, pair_limit: int = 64) -> DataFrame:
    """For each fingerprint of ``prints(doc_id, tag, fp)`` its ``root`` and ``component_id``.

    The component's id is its smallest doc_id; null if none of its documents has one.
    """
    least = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    found = connected_components(links(least.select("fp"), bits, pair_limit))
    rooted = least.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    # Both staged, as Spark splits a very large component only in a join of two tables.
    rooted = stage(rooted, "roots")
    ids = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component_ids")
    return stage(rooted.join(ids, "root").select("fp", "root", "component_id"), "near_duplicates")


def simhash_groups(
    documents: DataFrame, words: int = 3, bits: int = 2, pair_limit: int = 64
) -> DataFrame:
    """doc_id, tag, fingerprint (16 hexadecimal digits), root and component_id of every document.

    A null text has no words, like an empty one: its fingerprint is zero, and it is linked
    like any other. Equal rows give equal rows. An empty table gives an empty result.
    """
    prints = stage(fingerprints(documents, words), "simhash")
    return prints.join(components(prints, bits, pair_limit), "fp").select(
        "doc_id",
        "tag",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "root",
        "component_id",
    )


def drop_near_duplicates(documents: DataFrame, words: int = 3, bits: int = 2) -> DataFrame:
    """One row of each group, that of the smallest doc_id (null ids last), with all its columns.

    Of rows that are repeated one is kept; only if there are such rows among those kept are the
    documents shuffled again to find them.
    """
    groups = simhash_groups(documents, words, bits)
    rows = groups.groupBy("root", "doc_id", "tag").agg(F.count("*").alias("copies"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag", "copies")
    chosen = rows.groupBy("root").agg(F.min(first).alias("first"))
    kept = stage(chosen.select("root", "first.doc_id", "first.tag", "first.copies"), "kept")
    found = with_rows(documents, kept)
    if not kept.where("copies > 1").isEmpty():
        found = found.dropDuplicates(["root"])
    return found.select("row.*")
