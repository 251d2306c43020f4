"""Aggregates in which one missing input makes the result missing."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def _over(aggregate: Column, window: WindowSpec | None) -> Column:
    return aggregate if window is None else aggregate.over(window)


def _strict(aggregate: Column, column: str | Column, window: WindowSpec | None) -> Column:
    complete = _over(F.count(column), window) == _over(F.count(F.lit(1)), window)
    return F.when(complete, _over(aggregate, window))


def sum_strict(column: str | Column, window: WindowSpec | None = None) -> Column:
    return _strict(F.sum(column), column, window)


def max_strict(column: str | Column, window: WindowSpec | None = None) -> Column:
    return _strict(F.max(column), column, window)
