"""Tests, bounds and labels of a test cell against the control.

Arguments are SQL expressions or column names. Sign conventions differ by analysis and
are part of the results: ``with_welch`` and the care rates use control minus test, the
cumulative series test minus control.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitmetrics.functions.student import t_pvalue

# Normal bounds for 95 / 90 / 80 % confidence, by number of tails.
TWO_TAIL_BOUNDS = {95: 1.96, 90: 1.6449, 80: 1.2816}
ONE_TAIL_BOUNDS = {95: 1.6449, 90: 1.2816, 80: 0.8416}

# Tail labels and result labels.
TAIL_LABELS = {0: "2tail", -1: "-1tail", 1: "+1tail"}
INCREASE, DECREASE, NO_CHANGE = "Significant Increase", "Significant Decrease", "Not significant"
CARE_INCREASE, CARE_DECREASE = "significant increase", "significant decrease"
CARE_NO_CHANGE = "No significant change"

# Z bucket edges of the cohort report; the inner two are not symmetric.
BUCKET_OUTER, BUCKET_INNER_LOW, BUCKET_INNER_HIGH = 1.96, -1.65, 1.64

# A standard error below this fraction of the means is rounding noise: constant data.
_CONSTANT_DATA = 10 * 2.220446049250313e-16


def relative_change(test: str, control: str) -> Column:
    return F.expr(f"try_divide(({test}) - ({control}), {control})")


def with_welch(
    frame: DataFrame,
    n: str = "n",
    mean: str = "value",
    variance: str = "var",
    z: str = "z_score",
    p: str = "pvalue",
    when: str = "true",
) -> DataFrame:
    """Welch's unequal-variance t (control - test) and its two-sided p-value.

    The arguments name the statistics of an arm; their columns have the prefixes ``c_``
    and ``t_``. Both results are null for an arm with fewer than two values, for constant
    data, and wherever ``when`` is not true.
    """
    error = {side: f"try_divide({side}_{variance}, {side}_{n})" for side in "ct"}
    usable = (
        f"{when} and c_{n} > 1 and t_{n} > 1 and _se > 0 and"
        f" _se >= {_CONSTANT_DATA!r}D * greatest(abs(c_{mean}), abs(t_{mean}))"
    )
    freedom = (
        f"try_divide(pow({error['c']} + {error['t']}, 2),"
        f" pow({error['c']}, 2) / (c_{n} - 1) + pow({error['t']}, 2) / (t_{n} - 1))"
    )
    return (
        frame.withColumn("_se", F.expr(f"sqrt({error['c']} + {error['t']})"))
        .withColumn(z, F.expr(f"if({usable}, (c_{mean} - t_{mean}) / _se, null)"))
        .withColumn(p, t_pvalue(z, f"if({z} is not null, {freedom}, null)"))
        .drop("_se")
    )


def pooled_share(hits: str, n: str) -> Column:
    return F.expr(f"try_divide(c_{hits} + t_{hits}, c_{n} + t_{n})")


def pooled_error(share: str, n: str) -> Column:
    spread = f"{share} * (1 - {share})"
    return F.expr(f"sqrt(try_divide({spread}, t_{n}) + try_divide({spread}, c_{n}))")


def unpooled_error(share: str, n: str) -> Column:
    spread = {side: f"{side}_{share} * (1 - {side}_{share})" for side in "ct"}
    return F.expr(
        f"sqrt(try_divide({spread['t']}, t_{n}) + try_divide({spread['c']}, c_{n}))"
    )


def bound(tail_type: str, level: int) -> str:
    return f"if({tail_type} = 1, {ONE_TAIL_BOUNDS[level]}D, {TWO_TAIL_BOUNDS[level]}D)"


def confidence_limit(
    control: str, test: str, sd: str, tail_type: str, level: int, side: str
) -> Column:
    """Relative change at the lower (side ``-``) or upper (``+``) end of the confidence range."""
    return relative_change(f"{test} {side} {bound(tail_type, level)} * {sd}", control)


def _by_tail(z: str, tail: str, increase, decrease, neither) -> Column:
    """Pick by direction; a one-tailed metric looks only in the direction it expects."""
    two, one = TWO_TAIL_BOUNDS[95], ONE_TAIL_BOUNDS[95]
    both, low, high = TAIL_LABELS[0], TAIL_LABELS[-1], TAIL_LABELS[1]
    return F.expr(
        f"case when ({tail} = '{both}' and {z} <= -{two}D) or ({tail} = '{high}' and {z} <= -{one}D)"
        f" then {increase!r}"
        f" when ({tail} = '{both}' and {z} >= {two}D) or ({tail} = '{low}' and {z} >= {one}D)"
        f" then {decrease!r} when {z} is not null then {neither!r} end"
    )


def tail_label(z: str, tail: str) -> Column:
    return _by_tail(z, tail, INCREASE, DECREASE, NO_CHANGE)


def chart_code(z: str, tail: str) -> Column:
    """1 for an increase, 5 for a decrease, 3 for neither."""
    return _by_tail(z, tail, 1, 5, 3)


def care_label(z: str, limit: float) -> Column:
    return F.expr(
        f"case when {z} >= {limit}D then '{CARE_DECREASE}' when {z} <= -{limit}D then"
        f" '{CARE_INCREASE}' when {z} is not null then '{CARE_NO_CHANGE}' end"
    )


def significance_flag(z: str) -> Column:
    """1 strictly outside the two-tailed 95 % bounds, else 0."""
    return F.expr(
        f"case when abs({z}) > {TWO_TAIL_BOUNDS[95]}D then 1 when {z} is not null then 0 end"
    )


def z_bucket(z: str) -> Column:
    """1 and 5 outside the outer edges, 2 and 4 between the edges, 3 inside."""
    return F.expr(
        f"case when {z} <= -{BUCKET_OUTER}D then 1 when {z} <= {BUCKET_INNER_LOW}D then 2"
        f" when {z} >= {BUCKET_OUTER}D then 5 when {z} >= {BUCKET_INNER_HIGH}D then 4"
        f" when {z} is not null then 3 end"
    )
