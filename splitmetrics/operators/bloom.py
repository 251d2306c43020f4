"""A Bloom filter of ids as a small table, to drop rows of other ids before they are shuffled.

The filter is a table of words of 64 bits. An id's hash picks one word and four bits in it, so a test is one lookup in
a broadcast table. An id that was put in always passes; another one passes with a small probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter for each id, and in how few it is still worth its broadcast.
BITS = 12
LEAST_BITS = 4
#: Words of the largest filter: some 50 MB when broadcast.
MOST_WORDS = 1 << 21

_SET_BITS = 4


def words_for(ids: int) -> int | None:
    """Words of a filter of so many ids; None if even the largest one would let most others pass."""
    wanted = max(1, -(-ids * BITS // 64))
    if wanted <= MOST_WORDS:
        return wanted
    return MOST_WORDS if ids * LEAST_BITS <= MOST_WORDS * 64 else None


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bits(key: Column) -> Column:
    """Four bits of a word, from a second hash."""
    second = F.xxhash64(key, F.lit("bits"))
    bits = F.lit(0).cast("long")
    for k in range(_SET_BITS):
        place = F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def bloom_filter(rows: DataFrame, key: str, words: int) -> DataFrame:
    """The words that hold an id of ``rows``: at most ``words`` rows, combined before the shuffle."""
    ids = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"))
    return ids.groupBy(_word(F.col("id"), words).alias("_word")).agg(F.bit_or(_bits(F.col("id"))).alias("_mask"))


def probably_in(rows: DataFrame, key: str, table: DataFrame, words: int) -> DataFrame:
    """Rows whose id is in the filter, or seems to be; the rows keep their columns and are not shuffled."""
    id_ = F.col(key).cast("long")
    probed = rows.withColumns({"_word": _word(id_, words), "_own": _bits(id_)})
    met = probed.join(F.broadcast(table), "_word")
    return met.where(F.col("_mask").bitwiseAND(F.col("_own")) == F.col("_own")).drop("_word", "_own", "_mask")
