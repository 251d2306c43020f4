"""Input tables: names, whole-table and chunked reads, extra constraints."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableNames:
    """Names of an experiment's tables, by platform type and test id."""

    test_type_id: int
    test_id: int
    visitor_prefix: str = "visitors"
    order_prefix: str = "orders"
    database: str | None = None

    def _name(self, prefix: str, suffix: str = "") -> str:
        name = f"{prefix}_{self.test_type_id}_{self.test_id}{suffix}"
        return f"{self.database}.{name}" if self.database else name

    @property
    def visitors(self) -> str:
        return self._name(self.visitor_prefix)

    @property
    def orders(self) -> str:
        return self._name(self.order_prefix)

    @property
    def credits(self) -> str:
        return self._name(self.order_prefix, "_credit_level")

    @property
    def contacts(self) -> str:
        return self._name(self.visitor_prefix, "_contact_level")


@dataclass(frozen=True)
class RawTableNames:
    """Names of the tables of raw events, which experiments share."""

    orders: str = "raw_orders"
    credits: str = "raw_credits"
    contacts: str = "raw_contacts"


def read_table(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A catalog table, or the parquet table of that name in ``folder``."""
    return spark.read.parquet(f"{folder}/{name}") if folder else spark.read.table(name)


def condition_of(constraint: str | None) -> str:
    """The SQL condition of a constraint, which may begin with AND; empty if there is none."""
    text = (constraint or "").strip()
    leading = re.match(r"and\b", text, re.IGNORECASE)
    return text[leading.end() :].strip() if leading else text


def with_constraint(table: DataFrame, constraint: str | None) -> DataFrame:
    """Keep the rows that satisfy a SQL condition; a leading AND is accepted."""
    condition = condition_of(constraint)
    return table.where(F.expr(condition)) if condition else table


def chunk_predicates(key: str, chunks: int, constraint: str | None = None) -> list[str]:
    """SQL conditions that split a table by an integer key, each row into exactly one chunk.

    The remainder is shifted to be non-negative, so negative keys are not lost.
    """
    if chunks < 1:
        raise ValueError("chunks must be at least 1")
    condition = condition_of(constraint)
    also = f" and ({condition})" if condition else ""
    remainder = f"(({key} % {chunks}) + {chunks}) % {chunks}"
    return [f"{remainder} = {i}{also}" for i in range(chunks)]


def read_chunks(table: DataFrame, key: str, chunks: int, constraint: str | None = None) -> DataFrame:
    """The chunks of a table, read one by one and appended."""
    parts = [table.where(F.expr(p)) for p in chunk_predicates(key, chunks, constraint)]
    return reduce(DataFrame.unionByName, parts)


def read_jdbc_chunked(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    chunks: int = 1,
    constraint: str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table as one partition per chunk, fetched in parallel."""
    return spark.read.jdbc(
        url,
        table,
        predicates=chunk_predicates(key, chunks, constraint),
        properties=properties or {},
    )


def save_bucketed(table: DataFrame, name: str, buckets: int, key: str = "visitor_id") -> None:
    """Save a table bucketed on the join key.

    With orders bucketed like this, the roll-up to the order profile shuffles nothing.
    """
    table.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name)
