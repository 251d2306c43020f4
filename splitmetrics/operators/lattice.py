"""Visitor counts by all dimensions at once, from which the counts by any of them follow.

The cohorts, the shares of dimension values and their evenness all count visitors by cell and
one dimension at a time, of visitors chosen by hopper level, exposure, role and constraint. What they choose
by is kept in the finest grouping, so one pass over the visitors, with partial aggregation, serves them all;
each of them then only adds up its rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.functions.moments import count_true
from splitmetrics.sources.tables import condition_of

CELL_COLUMNS = ("test_name", "test_sub_id", "test_sub_name", "control_test")
#: Whether the visitors of a group satisfy the constraint.
IN_ANALYSIS = "in_analysis"


def count_lattice(visitors: DataFrame, dimensions: Iterable[str], constraint: str | None = None) -> DataFrame:
    """Visitors and valid ones by cell, hopper level, exposure, ``in_analysis`` and all ``dimensions``.

    ``in_analysis`` is the constraint's value, true where there is none and null where it is unknown.
    """
    keys = dict.fromkeys([*CELL_COLUMNS, "is_hopper", "exposed_to_test", *dimensions])
    condition = F.expr(condition_of(constraint) or "true").alias(IN_ANALYSIS)
    return visitors.groupBy(*keys, condition).agg(
        F.count("*").alias("visitors"), count_true("visitor_id > 0").alias("valid_visitors")
    )


def by_dimension(rows: DataFrame, names: Iterable[str], *kept: str) -> DataFrame:
    """Each row once per dimension, as (cohort, dimension value); narrow, and not shuffled.

    Meant for rows that are grouped by the dimensions already.
    """
    entries = ", ".join(
        f"named_struct('cohort', '{name}', 'dimension', cast(`{name}` as string))" for name in names
    )
    return rows.selectExpr(*kept, f"inline(array({entries}))")
