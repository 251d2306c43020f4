"""Exact quantiles with linear interpolation (position (n - 1) * p)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: One over the rank error of the sketch, and how far a bracket may reach around its level, both as shares
#: of the values. The least reach that spans three ranks is taken first.
_ACCURACY = 10_000
_REACHES = (5e-4, 8e-3, 1.0)
_RANKS = 3


def exact_quantiles(frame: DataFrame, levels: dict[str, Sequence[float]]) -> DataFrame:
    """One row with, for each column, the array of its quantiles at the given levels."""
    found = quantile_values(frame, levels)
    columns = [
        (F.lit(None) if values is None else F.array(*map(F.lit, values))).cast("array<double>").alias(name)
        for name, values in found.items()
    ]
    return frame.sparkSession.range(1).select(*columns)


def quantile_values(frame: DataFrame, levels: dict[str, Sequence[float]]) -> dict[str, list[float] | None]:
    """For each column its quantiles at the given levels, as numbers.

    Nulls and NaN are not values; a column without any has None. Every size takes the same
    way, and the numbers are those of Spark's ``percentile``: where the two values around a position
    are equal, the quantile is that value.

    Two passes over the columns: the first merges a bounded rank sketch per column, which gives a bracket
    of two values around each level. The second counts the values between the brackets and, within them, how often
    each value stands, so only about one value in a thousand is shuffled for a level, and a value that a third of the
    rows share is one row. Ranks are exact from these counts, whatever the sketch said: should one lie outside its bracket,
    the next wider brackets are counted.
    """
    sketch = _sketch(frame, levels)
    found: dict[str, list[float] | None] = dict.fromkeys(levels)
    step = {
        name: next(k for k, r in enumerate(_REACHES) if r * total >= _RANKS or r == 1)
        for name, (total, _) in sketch.items()
        if total
    }
    while step:
        brackets = {name: _brackets(levels[name], sketch[name][1], _REACHES[k]) for name, k in step.items()}
        values = _values_at_ranks(frame, {name: levels[name] for name in step}, brackets)
        for name in list(step):
            total = sketch[name][0]
            at = {rank: values.get((name, rank)) for rank in _ranks(levels[name], total)}
            if None in at.values():
                step[name] += 1
            else:
                found[name] = [_interpolated(at, total, p) for p in levels[name]]
                del step[name]
    return found


def _numbers(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    return frame.select(*[F.nanvl(F.col(name).cast("double"), F.lit(None)).alias(name) for name in names])


def _around(level: float, reach: float) -> tuple[float, float]:
    return max(0.0, level - reach), min(1.0, level + reach)


def _sketch(frame: DataFrame, levels: dict[str, Sequence[float]]) -> dict[str, tuple[int, dict[float, float]]]:
    """Each column's number of values, and values near every share that a bracket may end at."""
    asked = {
        name: sorted({end for p in points for reach in _REACHES for end in _around(float(p), reach)})
        for name, points in levels.items()
    }
    columns = []
    for name, shares in asked.items():
        columns += [F.count(name), F.percentile_approx(name, shares, _ACCURACY)]
    row = _numbers(frame, list(levels)).agg(*columns).first()
    return {
        name: (row[2 * k], dict(zip(shares, row[2 * k + 1] or (), strict=False)))
        for k, (name, shares) in enumerate(asked.items())
    }


def _brackets(points: Sequence[float], sketch: dict[float, float], reach: float) -> list[tuple[float, float]]:
    """Disjoint intervals, in order, in which the quantiles lie as far as the sketch can tell."""
    merged: list[tuple[float, float]] = []
    for p in sorted(map(float, points)):
        low, high = (sketch[end] for end in _around(p, reach))
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def _slot(value: Column, intervals: list[tuple[float, float]]) -> Column:
    """Twice the number of intervals below the value, and one more within an interval."""
    slot = F.lit(0)
    for low, high in intervals:
        slot = slot + (value >= low).cast("int") + (value > high).cast("int")
    return slot


def _values_at_ranks(
    frame: DataFrame, levels: dict[str, Sequence[float]], brackets: dict[str, list[tuple[float, float]]]
) -> dict[tuple[str, int], float]:
    """By column and wanted rank the value there, null where it is outside all brackets."""
    entries = []
    for name, intervals in brackets.items():
        slot = F.when(F.col(name).isNotNull(), _slot(F.col(name), intervals))
        inside = F.when(slot % 2 == 1, F.col(name))
        entries.append(F.struct(F.lit(name).alias("name"), slot.alias("slot"), inside.alias("value")))
    counted = (
        _numbers(frame, list(brackets))
        .select(F.inline(F.array(*entries)))
        .where("slot is not null")
        .groupBy("name", "slot", "value")
        .agg(F.count("*").alias("copies"))
    )
    # What is in the brackets, counted, is small enough for one sort.
    column = Window.partitionBy("name").orderBy("slot", "value")
    whole = column.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = counted.coalesce(1).withColumns(
        {
            "upto": F.sum("copies").over(column.rowsBetween(Window.unboundedPreceding, 0)),
            "total": F.sum("copies").over(whole),
        }
    )
    positions = F.lit(None).cast("array<double>")
    for name in brackets:
        points = F.array(*[(F.col("total") - 1) * F.lit(float(p)) for p in levels[name]])
        positions = F.when(F.col("name") == name, points).otherwise(positions)
    ranks = F.array_distinct(
        F.concat(F.transform(positions, lambda x: F.floor(x)), F.transform(positions, lambda x: F.ceil(x)))
    )
    here = F.filter(ranks, lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("copies")))
    rows = ranked.select("name", "value", F.explode(here).alias("rank")).collect()
    return {(r["name"], r["rank"]): r["value"] for r in rows}


def _ranks(points: Sequence[float], total: int) -> set[int]:
    return {whole((total - 1) * float(p)) for p in points for whole in (math.floor, math.ceil)}


def _interpolated(at: dict[int, float], total: int, level: float) -> float:
    position = (total - 1) * float(level)
    low, high = math.floor(position), math.ceil(position)
    below, above = at[low], at[high]
    return below if below == above else (high - position) * below + (position - low) * above


def upper_capped(value: Column, cap: float) -> Column:
    """Values above the cap become the cap; null stays null."""
    return F.when(value > cap, cap).otherwise(value)


def two_sided_capped(value: Column, low: float, high: float) -> Column:
    capped = upper_capped(value, high)
    return F.when(capped < low, low).otherwise(capped)
