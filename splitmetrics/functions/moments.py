"""Count, mean and sum of squared deviations: the statistics the tests need, kept mergeable.

Arguments are SQL expressions or column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_true(condition: str) -> Column:
    """Rows for which ``condition`` holds, as a bigint that is 0 over no rows."""
    return F.expr(f"count_if({condition})")


def moments(value: str, prefix: str) -> list[Column]:
    """Aggregates ``<prefix>_n``, ``<prefix>_mean`` and ``<prefix>_m2`` of the non-null values."""
    return [
        F.expr(f"count({value}) as {prefix}_n"),
        F.expr(f"avg({value}) as {prefix}_mean"),
        F.expr(f"var_pop({value}) * count({value}) as {prefix}_m2"),
    ]


def sample_variance(n: str, m2: str) -> str:
    return f"if({n} > 1, {m2} / ({n} - 1), null)"


def with_zeros(prefix: str, total: str) -> tuple[str, str]:
    """Mean and sample variance of summarised values once zeros bring them up to ``total``."""
    n, mean, m2 = (f"coalesce({prefix}_{part}, 0)" for part in ("n", "mean", "m2"))
    merged_mean = f"try_divide({n} * {mean}, {total})"
    merged_m2 = f"({m2} + {mean} * {mean} * try_divide({n} * ({total} - {n}), {total}))"
    return merged_mean, sample_variance(total, merged_m2)


def share_and_variance(hits: str, total: str) -> tuple[str, str]:
    """Mean and sample variance of a 0/1 flag that is 1 on ``hits`` of ``total`` rows."""
    share = f"try_divide({hits}, {total})"
    return share, f"if({total} > 1, {share} * ({total} - {hits}) / ({total} - 1), null)"
