"""Packing of tokenised documents into sequences, first-fit decreasing in random groups.

A document's ids, then the end id, are cut into pieces of a full sequence and a rest. Pieces
are dealt into groups by a hash, about ``group_pieces`` to a group, and each group is packed
on its own: the pieces in decreasing length, each into the first sequence that has room. A
tournament tree over the sequences' free room finds that one in logarithmic time. A group's size
depends on no property of the data, so there is no hot group, and one group bounds a task's memory.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.llm.rows import map_rows
from splitmetrics.llm.tokens import VOCABULARY, token_ids
from splitmetrics.sources.workspace import stage

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"
_PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_BINS_IN_A_GROUP = 1 << 32


class FirstFit:
    """Bins of one capacity; ``place`` puts an item into the first bin with room for it."""

    def __init__(self, capacity: int, items: int):
        self.capacity = capacity
        self.leaves = 1 << max(0, items - 1).bit_length()
        # Each node has the most room of the bins below it; bins not begun have all of it.
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """The bin, and where in it the item begins."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        before = self.capacity - room[node]
        room[node] -= size
        chosen = node - self.leaves
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return chosen, before


def pieces(documents: DataFrame, capacity: int, end_id: int, vocabulary: str) -> DataFrame:
    """A row for each piece of each document, with the checksum of its ids."""

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        for row, (doc_id, text) in enumerate(rows):
            ids = np.append(token_ids(text, vocabulary), np.array([end_id], "<u4")).astype("<u4")
            for start in range(0, len(ids), capacity):
                part = ids[start : start + capacity]
                yield doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids), row

    return map_rows(documents.select("doc_id", "text"), cut, _PIECES)


def _pack_group(capacity: int):
    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(
            ["length", "doc_id", "start", "salt"], ascending=[False, True, True, True]
        )
        fit = FirstFit(capacity, len(group))
        places = [fit.place(size) for size in group["length"].tolist()]
        bins, offsets = zip(*places, strict=True)
        group["sequence_id"] = np.array(bins, np.int64) + int(key[0]) * _BINS_IN_A_GROUP
        group["offset"] = np.array(offsets, np.int64)
        group["doc_id"] = group["doc_id"].astype("Int64")
        return group.drop(columns=["salt", "pack"])

    return pack


def pack_documents(
    documents: DataFrame,
    capacity: int = 2048,
    end_id: int = 1,
    vocabulary: str = VOCABULARY,
    group_pieces: int = 8192,
    seed: int = 0,
) -> DataFrame:
    """Where every piece of every document lies: sequence_id and offset, gapless from 0.

    Columns: doc_id, start (the document's ids before the piece), length, ids_crc32 (of the
    little-endian unsigned 32-bit ids), doc_tokens (with the end id), sequence_id, offset. A null
    or empty text is one piece of the end id alone. Repeated rows and null ids are documents
    of their own. An empty table gives an empty result.
    """
    cut = stage(pieces(documents, capacity, end_id, vocabulary), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn(
        "pack",
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", "salt"), F.lit(groups)),
    )
    return dealt.groupBy("pack").applyInPandas(_pack_group(capacity), _PACKED)
